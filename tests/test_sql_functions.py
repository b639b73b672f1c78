"""SQL functions give what the expressions give."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.functions import dates, scalars, sql_functions


def test_scalars_on_edges(spark):
    sql_functions.register(spark)
    hours = spark.createDataFrame([(h,) for h in [*range(24), None]], "hour int")
    got = hours.selectExpr("ledger_is_night(hour) AS n", "ledger_is_core(hour) AS c")
    want = hours.select(scalars.in_hours(F.col("hour"), *scalars.NIGHT_HOURS).alias("n"), scalars.in_hours(F.col("hour"), *scalars.CORE_HOURS).alias("c"))
    assert got.collect() == want.collect()
    amounts = spark.createDataFrame([(8.0, 100.0, -8.0), (0.0, 0.0, 0.0), (5.0, 95.0, None), (10.0, 85.0, 5.0), (0.0, 1.0, 0.0)], "t double, s double, d double")
    percent = scalars.tax_percent(F.col("t"), F.col("s"), F.col("d"))
    got = amounts.selectExpr("ledger_tax_percent(t, s, d) AS p", "ledger_tax_band(ledger_tax_percent(t, s, d)) AS b", "ledger_ratio(t, s) AS r", "ledger_ratio(t, d, NULL) AS q")
    want = amounts.select(percent.alias("p"), scalars.tax_band(percent).alias("b"), scalars.ratio(F.col("t"), F.col("s")).alias("r"), scalars.ratio(F.col("t"), F.col("d"), None).alias("q"))
    assert got.collect() == want.collect()


def test_windows_of_a_run_date(spark):
    sql_functions.register(spark)
    for run in (dt.date(2024, 3, 15), dt.date(2024, 1, 1), dt.date(2023, 12, 31)):
        last = dates.last_closed_day(run)
        got = {r["window_name"]: (r["first_day"], r["last_day"]) for r in spark.sql(f"SELECT * FROM ledger_windows(DATE '{run}')").collect()}
        assert got == {name: (start, last) for name, start in dates.trailing_starts(last).items()}
        assert spark.sql(f"SELECT ledger_closed_day(DATE '{run}') AS d").first()["d"] == last


def test_bodies_become_part_of_the_plan(spark):
    """No call is left for the executors: filters on a result reach the rows."""
    sql_functions.register(spark)
    spark.range(10).selectExpr("CAST(id AS INT) AS hour").createOrReplaceTempView("t_hours")
    text = spark.sql("SELECT ledger_is_night(hour) AS n FROM t_hours WHERE ledger_is_core(hour)")._jdf.queryExecution().executedPlan().toString()
    assert "ledger_is" not in text
