"""SQL twins of the queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from oracle.queries import QUERIES
from oracle.views import VIEWS

_NAME = re.compile(r"\bw_\w+")


def _needed(sql: str, seen: list[str]) -> list[str]:
    """Views a statement draws on, each after those it needs itself."""
    for name in dict.fromkeys(_NAME.findall(sql)):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def statement(sql: str) -> str:
    names = _needed(sql, [])
    if not names:
        return sql.strip()
    views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    own = sql.strip()
    # A statement may name parts of its own as well.
    return f"WITH {views},\n{own.removeprefix('WITH ')}" if own.startswith("WITH ") else f"WITH {views}\n{own}"


def statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
