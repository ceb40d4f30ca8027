"""Semantics worth pinning down, and arithmetic relations of one known run."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from permeate.functions import scalars as s
from permeate.functions.missing import enough, nan_to_null, ratio
from permeate.functions.regression import fit_from_moments, fit_lines, moments
from permeate.functions.timing import DAY, SECOND, calendar_features, micros, parse_stamp, span, to_stamp, width
from permeate.operators import quality
from permeate.operators.charts import decline_note, path, refit
from permeate.operators.forecast import choose_model, forecast
from permeate.operators.fouling import add_decline, permeability_baseline, tmp_slopes
from permeate.operators.kpis import alerts, kpi_table, per_week
from permeate.operators.ordering import row_index
from permeate.operators.quantiles import fence, group_quantiles
from permeate.storage import stage


def one(df):
    return df.first()[0]


@pytest.mark.parametrize(
    "raw,micro",
    [("2026-01-28 03:30:04 48", 480_000), ("2026-01-28 03:30:04 5", 500_000), ("2026-01-28 03:30:04", 0)],
)
def test_stamp_fraction(spark, raw, micro):
    got = one(spark.createDataFrame([(raw,)], "t string").select(parse_stamp(F.col("t"))))
    assert got == dt.datetime(2026, 1, 28, 3, 30, 4, micro)


def test_unreadable_stamp_is_missing(spark):
    assert one(spark.createDataFrame([("28.01.26",)], "t string").select(parse_stamp(F.col("t")))) is None


def test_stamp_and_micros_are_inverse(spark):
    df = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.999999' as ts").withColumn("us", micros("ts"))
    row = df.select("us", to_stamp(F.col("us")).alias("back"), "ts").first()
    assert row.us == -1 and row.back == row.ts


def test_durations(spark):
    assert (width("30min"), width("6h"), width("7d"), width("1.5h")) == (1800 * SECOND, 21_600 * SECOND, 7 * DAY, 5400 * SECOND)
    assert one(spark.range(1).select(span(F.lit(0), F.lit(DAY), "hours"))) == 24.0


def test_nan_becomes_missing_and_zero_divides_to_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,)], "v double")
    assert one(nan_to_null(df).agg(F.avg("v"))) == 2.0
    assert one(spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0)))) is None


def test_calendar_counts_from_monday(spark):
    row = spark.sql("select timestamp_ntz'2026-01-31 06:00:00' as ts").select(
        *[c.alias(n) for n, c in calendar_features(F.col("ts")).items()]
    ).first()
    assert (row.hour, row.day_of_week, row.day_of_month, row.is_weekend) == (6, 5, 31, 1)
    assert row.hour_sin == pytest.approx(1.0) and row.hour_cos == pytest.approx(0.0, abs=1e-12)


def test_severity_uses_the_size_of_the_rate(spark):
    df = spark.createDataFrame([(-0.03,), (0.0049,), (0.005,), (0.05,), (None,)], "v double")
    assert [r[0] for r in df.select(s.severity(F.col("v"), (0.005, 0.02, 0.05))).collect()] == [
        "high", "low", "medium", "critical", None
    ]


def test_scalar_formulas(spark):
    row = spark.range(1).select(
        s.temperature_factor(F.lit(12.0), 10.0), s.hydraulic_efficiency(F.lit(8.0), F.lit(1.9)),
        s.recovery_per_energy(F.lit(80.0), F.lit(0.099)), s.from_log(s.to_log(F.lit(3.3))), s.half_even(F.lit(0.125), 2),
    ).first()
    assert row[0] == pytest.approx(1.025**2) and row[1] == pytest.approx(4.0) and row[2] == pytest.approx(800.0)
    assert row[3] == pytest.approx(3.3) and row[4] == pytest.approx(0.12)


def test_line_skips_missing_pairs_and_daily_sums_add_up(spark):
    rows = [("u", i * 3600 * SECOND, None if i % 7 == 0 else 2.0 + 0.01 * i + (i % 3) * 0.1) for i in range(200)]
    df = spark.createDataFrame(rows, "unit_id string, us long, tmp double")
    whole = fit_lines(df, "tmp").first()
    parts = fit_from_moments(moments(df.withColumn("day", F.floor(F.col("us") / DAY)), "tmp", ("unit_id", "day"))).first()
    assert whole.n == parts.n == 171
    assert parts.slope == pytest.approx(whole.slope, rel=1e-9) and parts.r_squared == pytest.approx(whole.r_squared, rel=1e-9)


def test_single_reading_has_no_slope(spark):
    row = tmp_slopes(spark.createDataFrame([("u", 0, 1.0)], "unit_id string, us long, tmp double")).first()
    assert row.slope_per_hour is None and row.fouling_class is None


def test_first_failed_band_counts_once(spark):
    bands = {"a": (0.0, 1.0), "b": (0.0, 1.0)}
    df = spark.createDataFrame([("u", 5.0, 5.0), ("u", 0.5, None), ("u", 1.0, 0.0), ("u", 0.5, 9.0)], "unit_id string, a double, b double")
    got = {r.parameter: r.removed for r in quality.outlier_counts(df, bands).collect()}
    kept = quality.retention(df, bands).first()
    assert got == {"a": 1, "b": 2} and sum(got.values()) == kept.rows_removed and kept.rows_out == 1
    assert quality.band_filter(df, bands).count() == 1


def test_band_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("u", 5.0)], "unit_id string, a double")
    df.write.parquet(str(tmp_path / "t"))
    plan = quality.band_filter(spark.read.parquet(str(tmp_path / "t")), {"a": (0.0, 8.0)})._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(a,0.0)" in pushed and "LessThanOrEqual(a,8.0)" in pushed


def test_required_columns(spark):
    with pytest.raises(ValueError, match="flux"):
        quality.require_columns(spark.range(1), ["id", "flux"])
    assert quality.missing_columns(spark.range(1), ["id"]) == []


def test_a_gap_must_be_longer_than_the_limit(spark):
    rows = [("u", 0, 0), ("u", 300 * SECOND, 1), ("u", 660 * SECOND, 2)]
    log = stage(row_index(spark.createDataFrame(rows, "unit_id string, us long, seq long")), "t")
    assert [r.minutes for r in quality.stamp_gaps(log, 5).collect()] == [6.0]


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_quantiles_are_linear_even_with_many_equal_values(spark, n):
    import numpy as np

    values = [float(i % 4) for i in range(n)]
    df = spark.createDataFrame([("u", v, i) for i, v in enumerate(values)] + [("x", 3.0, i) for i in range(500)], "unit_id string, v double, seq long")
    got = {r.unit_id: r for r in group_quantiles(df, "v", {"p10": 0.1, "q": 0.75}).collect()}
    assert got["u"].p10 == pytest.approx(np.percentile(values, 10)) and got["u"].q == pytest.approx(np.percentile(values, 75))
    assert got["x"].p10 == 3.0 and got["x"].n == 500


def test_small_groups_are_not_fenced(spark):
    df = spark.createDataFrame([("u", v, i) for i, v in enumerate([1.0, 1.0, 90.0])], "unit_id string, v double, seq long")
    assert fence(df, "v", at_least=4).filter("inside").count() == 3


def test_guard(spark):
    assert one(spark.range(3).agg(enough(F.count("*"), 4, F.sum("id")))) is None
    assert one(spark.range(4).agg(enough(F.count("*"), 4, F.sum("id")))) == 6


# --- relations between figures of one known run (14.66 days, 238,197 rows) ---

SLOPE_DAY, FIT_LAST = 0.00645132, 3.750182


def line(spark, slope_day=SLOPE_DAY, last=FIT_LAST, days=14.656, n=200, name="tmp"):
    rows = [("u", round(days * DAY * i / (n - 1)), i, last - slope_day * days * (1 - i / (n - 1))) for i in range(n)]
    return spark.createDataFrame(rows, f"unit_id string, us long, seq long, {name} double")


def test_days_to_the_limit_count_from_the_last_reading(spark):
    row = forecast(line(spark), parameters=("tmp",)).first()
    want = (8 - FIT_LAST) / SLOPE_DAY
    assert row.time_to_threshold == pytest.approx(want, rel=1e-6)
    # Subtracting the elapsed time once more gives the figure that run reported.
    assert row.time_to_threshold - 14.656 == pytest.approx(644.0952, abs=0.05)
    assert row.predicted_value == pytest.approx(FIT_LAST + 7 * SLOPE_DAY)
    assert row.upper_bound - row.predicted_value == pytest.approx(row.predicted_value - row.lower_bound, abs=1e-9)


def test_slope_per_day_is_24_times_slope_per_hour(spark):
    row = tmp_slopes(line(spark)).first()
    assert row.slope_per_day == pytest.approx(24 * row.slope_per_hour) and row.fouling_class == "low"
    assert row.r_squared == pytest.approx(1.0)


def test_cleanings_per_week(spark):
    got = one(spark.range(1).select(per_week(F.lit(7), F.lit(0), F.lit(round(12.235 * DAY)))))
    assert got == pytest.approx(4.005, abs=1e-3)


def test_forecast_needs_enough_rows_and_a_known_model(spark):
    assert forecast(line(spark, n=99), parameters=("tmp",)).count() == 0
    with pytest.raises(ValueError):
        forecast(line(spark), model="polynomial")
    with pytest.raises(ValueError):
        choose_model("polynomial", "tmp")
    assert choose_model("ml_random_forest", "tmp", False) == "exponential"
    assert choose_model("ml_random_forest", "perm_tc", False) == "linear"


def test_exponential_forecast(spark):
    rows = [("u", i * 3600 * SECOND, i, math.exp(0.001 * i) - 0.1) for i in range(150)]
    row = forecast(spark.createDataFrame(rows, "unit_id string, us long, seq long, tmp double"), "exponential", parameters=("tmp",)).first()
    assert row.predicted_value == pytest.approx(math.exp(0.001 * (149 + 168)) - 0.1)
    assert row.time_to_threshold == pytest.approx((math.log(8.1) / 0.001 - 149) / 24)
    assert row.lower_bound == pytest.approx(row.predicted_value * 0.9) and row.r_squared == 0.0


def test_falling_tmp_and_passed_limit_give_no_days(spark):
    assert forecast(line(spark, slope_day=-0.1), parameters=("tmp",)).first().time_to_threshold is None
    perm = line(spark, slope_day=-0.1, last=5.0, name="perm_tc")
    critical = spark.createDataFrame([("u", 6.0)], "unit_id string, critical_level double")
    assert forecast(perm, parameters=("perm_tc",), critical=critical).first().time_to_threshold is None


def test_alert_levels(spark):
    figures = spark.createDataFrame(
        [("a", 0.06, 5.5229, 8.43612, 3.7), ("b", 0.02, 25.0, 8.0, 7.6), ("c", -0.9, None, None, 1.0)],
        "unit_id string, slope_per_hour double, permeability_decline_baseline double, permeability_baseline double, current_tmp double",
    )
    got = sorted((r.unit_id, r.alert_type, r.severity) for r in alerts(figures).collect())
    assert got == [("a", "tmp_slope", "critical"), ("b", "high_tmp", "warning"), ("b", "permeability_decline", "critical"), ("b", "tmp_slope", "warning")]


def test_kpis_without_cycles_or_rates(spark):
    rows = spark.createDataFrame([("u", 0, 0, 90.0, 0.2, 5.0)], "unit_id string, us long, seq long, recovery double, specific_power double, tmp double")
    none = spark.createDataFrame([], "unit_id string, duration_hours double, start_us long, end_us long, us long, reversible_rate double, irreversible_rate double")
    got = {r.name: (r.value, r.status) for r in kpi_table(rows, none, none, none).collect()}
    assert got == {
        "Average Recovery Rate": (90.0, "good"), "Average Specific Energy": (0.2, "warning"),
        "Chemical Cleaning Frequency": (0.0, None), "Current TMP": (5.0, "warning"),
    }


def test_decline_against_the_baseline(spark):
    rows = [("u", i * 1800 * SECOND, i, 8.43612 if i < 400 else 7.9702) for i in range(500)]
    log = stage(row_index(spark.createDataFrame(rows, "unit_id string, us long, seq long, perm_tc double")), "t")
    row = permeability_baseline(log).first()
    assert row.permeability_baseline == pytest.approx(8.43612) and row.permeability_decline_baseline == pytest.approx(5.5229, abs=1e-3)
    late = add_decline(log, start="1971-01-01 00:00:00")
    assert late.filter("permeability_baseline is null and perm_tc_decline_7d is not null").count() == 500


def test_refit_and_cone(spark):
    points = spark.createDataFrame([("u", i * DAY, 2.0 + 0.1 * i) for i in range(10)], "unit_id string, us long, tmp_start double")
    row = refit(points, "tmp_start", "1970-01-02 00:00:00", "1970-01-05 00:00:00").first()
    assert row.n == 4 and row.fitted_at_last == pytest.approx(2.9) and row.days_to_threshold == pytest.approx(31.0)
    ends = spark.createDataFrame([("u", 0, 19 * SECOND, 1.0, 20.0)], "unit_id string, a long, b long, x double, y double")
    c = F.col
    got = path(ends, c("a"), c("b"), c("x"), c("y"), c("y") - 5, c("y") + 5).orderBy("point").collect()
    assert [r.value for r in got] == pytest.approx([1.0 + i for i in range(20)])
    assert got[0].lower == got[0].upper == 1.0 and got[-1].upper - got[-1].lower == pytest.approx(10.0)


def test_decline_note(spark):
    points = spark.createDataFrame([("u", i * DAY, 10.0 - 0.02 * i) for i in range(6)], "unit_id string, us long, daily_value double")
    starts = spark.createDataFrame([("u", 10.0, 6.0)], "unit_id string, stable_start double, critical_level double")
    row = decline_note(points, starts).first()
    assert row.decline_class == "medium" and row.decline_percent_per_day == pytest.approx(0.2)
    assert row.days_to_critical == pytest.approx(3.9 / 0.02)
