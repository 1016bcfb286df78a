"""Money totals are plain sums of doubles; only the registered keys round them."""

import math

from conftest import ev, raw_frame
from tidemark.operators.marts import build_fct_events
from tidemark.operators.staging import clean_events
from tidemark.operators.value_flow import category_totals, money_rounded, value_flow


def _totals(spark, amounts, model=value_flow):
    rows = [ev(f"2024-01-0{1 + i % 9} 00:00:00", f"u{i}", "miles_earned", category="c", miles=m) for i, m in enumerate(amounts)]
    return model(build_fct_events(clean_events(raw_frame(spark, rows)))).first()


def test_small_huge_and_undefined_amounts(spark):
    for model in (value_flow, category_totals):
        assert math.isclose(_totals(spark, [0.0000004] * 5, model).total_miles, 0.000002)
        assert _totals(spark, [1e33, 1e33], model).total_miles == 2e33
        assert math.isnan(_totals(spark, [float("nan"), 1.0], model).total_miles)
        assert _totals(spark, [float("nan"), 1.0], model).transactions == 2


def test_null_amounts_count_for_categories_only(spark):
    assert _totals(spark, [None, 2.0]).transactions == 1
    row = _totals(spark, [None, None], category_totals)
    assert row.transactions == 2 and row.total_miles is None


def test_keys_round_to_cents(spark):
    rows = [ev("2024-01-01 00:00:00", f"u{i}", "miles_earned", miles=0.1) for i in range(3)]
    flow = value_flow(build_fct_events(clean_events(raw_frame(spark, rows))))
    assert money_rounded(flow).first().total_miles == 0.3
