"""Number, text and business rules at their limits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from packhouse.config import Settings
from packhouse.functions import numbers, rules, text


@pytest.fixture(scope="module")
def ev(spark):
    def run(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return list(row) if len(columns) > 1 else row[0]

    return run


def lit(v, kind="double"):
    return F.lit(v).cast(kind)


def test_round_half_up(ev):
    values = [1.005, 0.125, -0.005, 2.675, 10.0]
    assert ev(*[numbers.round_half_up(lit(v), 2) for v in values]) == [1.0, 0.13, 0.0, 2.68, 10.0]
    assert ev(*[numbers.round_half_up(lit(v), 0) for v in (-2.5, 2.5)]) == [-2.0, 3.0]


def test_to_fixed_uses_the_exact_value(ev):
    values = [1.005, 0.125, 8.345, -0.125, -0.001, 1234567.125]
    assert ev(*[numbers.to_fixed(lit(v), 2) for v in values]) == [1.0, 0.13, 8.35, -0.13, 0.0, 1234567.13]
    assert ev(*[numbers.to_fixed(lit(v), 1) for v in (1.45, 0.25, 0.05)]) == [1.4, 0.3, 0.1]


def test_parse_numbers(ev):
    texts = ["12abc", " 3.5kg", ".5", "-2", "", "abc", None, "1e2x"]
    assert ev(*[numbers.parse_float(lit(t, "string")) for t in texts]) == [12.0, 3.5, 0.5, -2.0, None, None, None, 100.0]
    assert ev(*[numbers.parse_int(lit(t, "string")) for t in ("12.9", "7 pieces", "", "x")]) == [12, 7, None, None]


def test_or_default_takes_zero_and_null(ev):
    assert ev(*[numbers.or_default(lit(v, "int"), 30) for v in (0, None, 15)]) == [30, 30, 15]


def test_pct_of_nothing_is_zero(ev):
    assert ev(numbers.pct(lit(5), lit(0)), numbers.pct(lit(5), lit(-1)), numbers.pct(lit(1), lit(4))) == [0.0, 0.0, 25.0]


def test_margin_zone_limits(ev):
    values = [75.0, 74.99, 65.0, 64.99, -3.0, 0.0]
    assert ev(*[rules.margin_zone(lit(v)) for v in values]) == ["green", "yellow", "yellow", "red", "red", "red"]


def test_waste_tier_limits(ev):
    assert ev(*[rules.waste_tier(lit(v)) for v in (10.0, 10.01, 5.0, 5.01)]) == ["yellow", "red", "green", "yellow"]


def test_line_revenue(ev):
    def revenue(is_super, packs):
        return rules.line_revenue(F.lit(is_super), lit(10), lit(3), lit(packs))

    assert ev(revenue(True, 12), revenue(True, 0), revenue(True, None), revenue(False, 12)) == [120.0, 30.0, 30.0, 30.0]


def test_recovered_packs(ev):
    def packs(applies, price, revenue):
        return rules.recovered_packs(F.lit(applies), lit(price), lit(revenue))

    got = ev(packs(True, 0, 10), packs(True, 4, 10), packs(True, 100, 10), packs(False, 4, 10), packs(True, 3, 10))
    assert got == [None, 3.0, 0.0, None, 3.0]
    assert ev(rules.recovered_size(lit(3), lit(12)), rules.recovered_size(lit(3), lit(0))) == [0.25, None]


def test_due_date(ev):
    def due(date, credit):
        return rules.due_date(F.lit(dt.date.fromisoformat(date)), lit(credit, "int"), 30)

    got = ev(due("2001-01-31", None), due("2001-01-31", 0), due("2001-01-31", 15), due("2000-02-29", 1))
    assert [str(d) for d in got] == ["2001-03-02", "2001-03-02", "2001-02-15", "2000-03-01"]


def test_waste(ev):
    waste = rules.waste_quantity(lit(None, "decimal(18,2)"), lit(2, "decimal(18,2)"))
    assert float(ev(waste)) == 2.0
    assert ev(rules.waste_percentage(lit(2), lit(0)), rules.waste_percentage(lit(1), lit(3))) == [0.0, 33.33]
    assert ev(rules.raw_waste_value(lit(2), lit(None), lit(0.5)), rules.raw_waste_value(lit(2), lit(3), lit(None))) == [1.0, 6.0]


def test_price_is_additive_and_calculator_multiplies(ev):
    s = Settings(20.0, 5.0)
    assert ev(rules.suggested_price(lit(100), lit(10), s)) == pytest.approx(135)
    cost = rules.pack_cost(lit(100), lit(0.5), s)
    assert ev(cost, rules.price_at_markup(cost, lit(10))) == pytest.approx([62.5, 68.75])
    assert ev(rules.markup_pct(lit(75), lit(60)), rules.markup_pct(lit(75), lit(0))) == [25.0, 0.0]
    assert ev(rules.price_per_kg(lit(5), lit(0.25)), rules.price_per_kg(lit(5), lit(0))) == [20.0, 0.0]


def test_markup_gives_the_price_back(ev):
    for cost, price in ((60.0, 75.0), (12.34, 99.99), (7.77, 3.21)):
        margin = numbers.to_fixed(rules.markup_pct(lit(price), lit(cost)), 1)
        again = ev(numbers.to_fixed(rules.price_at_markup(lit(cost), margin), 2))
        assert abs(again - price) <= cost * 0.0005 + 0.005 + 1e-9


def test_pack_labels(ev):
    name = F.lit("Tomato")
    got = ev(
        text.pack_label(name, lit(0.25), lit(4)),
        text.pack_label(name, lit(None), lit(4)),
        text.repack_label(F.lit("Tomato (0.25kg × 4)"), lit(0.5), lit(2)),
        text.repack_label(name, lit(0.5), lit(2)),
    )
    assert got == ["Tomato (0.25kg × 4)", "Tomato", "Tomato (0.5kg × 2)", "Tomato (0.5kg × 2)"]


def test_contact_link(ev):
    link = text.contact_link(F.lit("+20 (10) 55"), F.lit("Hi, A&B (x) ~ 5%! é+"))
    assert ev(link) == "https://wa.me/201055?text=Hi%2C%20A%26B%20(x)%20~%205%25!%20%C3%A9%2B"
    assert ev(text.contact_link(F.lit(None).cast("string"), F.lit("a"))) == "https://wa.me/?text=a"


def test_order_label(ev):
    known = text.order_label(F.lit("Nile"), F.lit(dt.date(2001, 8, 1)), F.lit("0123456789"))
    unknown = text.order_label(F.lit(None).cast("string"), F.lit(None).cast("date"), F.lit("0123456789"))
    assert ev(known, unknown) == ["Nile - 2001-08-01", "01234567"]
