from datetime import date

from tests.conftest import SF_DIR, rows, ticks
from tickloom.operators import universe
from tickloom.plans import views


def daily(spark):
    return spark.createDataFrame(
        [(date(2024, 3, 3), "A", 5.0), (date(2024, 3, 3), "B", 9.0), (date(2024, 3, 3), "C", 5.0),
         (date(2024, 3, 4), "D", 99.0)], "date date, T string, v double")


def test_top_symbols_of_the_day_before(spark):
    yesterday = universe.scan_daily_volume(daily(spark), date(2024, 3, 4))
    assert rows(universe.top_symbols(yesterday, 2)) == [("B", 9.0), ("A", 5.0)]


def test_ticks_of_the_universe_only(spark):
    source = ticks(spark, [("A", 1.0, 1.0, 0.0, 1), ("Z", 1.0, 1.0, 0.0, 2), ("B", 1.0, 1.0, 0.0, 3)])
    kept = universe.in_universe(source, universe.top_symbols(daily(spark)))
    assert [r[0] for r in rows(kept.select("Symbol"), "Symbol")] == ["A", "B"]
    assert "LeftSemi" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_top_symbols_keeps_only_n_rows_per_task(spark):
    source = views.lineitem_ticks(spark, SF_DIR)
    plan = universe.top_symbols(universe.daily_volume(source), 50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
