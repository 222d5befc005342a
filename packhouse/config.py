"""Parameters of the reports.  Defaults are the business rules in force."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Overhead and labor, in percent of cost: numbers, or columns of one value."""

    overhead_pct: float = 15.0
    labor_pct: float = 0.0

    @property
    def factor(self) -> float:
        return 1 + self.overhead_pct / 100 + self.labor_pct / 100


# Thresholds of the margin zones and of the coloured tiers.
@dataclass(frozen=True)
class Thresholds:
    zone_green: float = 75.0
    zone_yellow: float = 65.0
    margin_high: float = 30.0
    margin_mid: float = 15.0
    share_high: float = 15.0
    share_mid: float = 5.0
    waste_high: float = 10.0
    waste_mid: float = 5.0
    top_client_alert: float = 50.0


# Limits of the stock and price rules.
@dataclass(frozen=True)
class AdviceRules:
    busy_lines: int = 3
    busy_velocity: float = 2.0
    quiet_lines: int = 1
    quiet_velocity: float = 0.5
    low_margin: float = 25.0
    high_margin: float = 40.0
    raise_factor: float = 1.1
    spread_pct: float = 20.0
    underpriced_factor: float = 0.9


@dataclass(frozen=True)
class Params:
    as_of: dt.date
    week_days: int = 7
    lookback_days: int | None = None
    default_credit_days: int = 30
    # Given settings replace the saved ones.
    settings: Settings | None = None
    thresholds: Thresholds = field(default_factory=Thresholds)
    advice: AdviceRules = field(default_factory=AdviceRules)

    def days_before(self, n: int) -> dt.date:
        return self.as_of - dt.timedelta(days=n)
