"""Key figures, alerts and forecasts."""

from pyspark.sql import functions as F

from permeate.operators import kpis as k
from permeate.operators.charts import value_range
from permeate.operators.forecast import forecast
from permeate.operators.fouling import permeability_baseline, stable_start, tmp_slopes
from permeate.operators.quality import band_filter
from permeate.plans.adapter import BANDS, LOG_SQL, ORDERED_SQL, ordered_log, prepared, sensor_log
from permeate.plans.catalog.cycles import (
    CLEANINGS,
    CYCLE_TABLE,
    RATES,
    cleaning_table,
    cycle_table,
    rate_table,
    recursive,
)
from permeate.plans.catalog.fouling import FENCED_DAILY, WEEK, daily_points, smoothed
from permeate.plans.registry import query, rounded, stamp_text


def good_rows(spark, sf):
    return band_filter(ordered_log(spark, sf), BANDS)


FIGURES = """figures as (select unit_id, avg(recovery) as avg_recovery, avg(specific_power) as avg_specific_power,
    arg_max(tmp, us) as current_tmp, max(us) as last_us from ordered where good group by 1)"""
CYCLE_FIGURES = """cycle_figures as (select unit_id, avg(duration_hours) as avg_cycle_hours,
    case when count(*) > 1 then count(*) / ((max(end_us) - min(start_us)) / 86400e6 / 7.0) end as cycles_per_week from cycles group by 1)"""
CLEANING_FIGURES = """cleaning_figures as (select unit_id, round_even(case when count(*) > 1
    then count(*) / ((max(us) - min(us)) / 86400e6 / 7.0) else 0 end, 0) as cleanings_per_week from cleanings group by 1)"""


@query(
    "j1_j2_j6_log_figures",
    """select unit_id, round(avg_recovery, 6) as avg_recovery, round(avg_specific_power, 6) as avg_specific_power,
      round(current_tmp, 6) as current_tmp, last_us from figures""",
    ORDERED_SQL + ", " + FIGURES,
)
def log_figures(spark, sf):
    return k.log_figures(good_rows(spark, sf)).select(
        "unit_id", *rounded("avg_recovery", "avg_specific_power", "current_tmp"), "last_us"
    )


@query(
    "j3_j4_cycle_figures",
    "select unit_id, round(avg_cycle_hours, 6) as avg_cycle_hours, round(cycles_per_week, 6) as cycles_per_week from cycle_figures",
    CYCLE_TABLE + ", " + CYCLE_FIGURES,
)
def cycle_figures(spark, sf):
    return k.cycle_figures(cycle_table(spark, sf)).select("unit_id", *rounded("avg_cycle_hours", "cycles_per_week"))


@query(
    "j5_cleanings_per_week",
    "select unit_id, cast(cleanings_per_week as double) as cleanings_per_week from cleaning_figures",
    ORDERED_SQL + ", " + CLEANINGS + ", " + CLEANING_FIGURES,
)
def cleaning_figures(spark, sf):
    return k.cleaning_figures(cleaning_table(spark, sf))


_KPIS = ", ".join([RATES, FIGURES, CYCLE_FIGURES, CLEANING_FIGURES]) + """,
wide as (select * from figures left join cycle_figures using (unit_id) left join cleaning_figures using (unit_id) left join rates using (unit_id)),
kpis as (
  select unit_id, 'Average Recovery Rate' as name, avg_recovery as "value", '%' as unit, 85.0 as target,
    case when avg_recovery >= 85 then 'good' else 'warning' end as status from wide
  union all select unit_id, 'Average Specific Energy', round_even(avg_specific_power, 2), 'kWh/m³', 0.15,
    case when avg_specific_power <= 0.15 then 'good' else 'warning' end from wide
  union all select unit_id, 'Average Cycle Duration', round_even(avg_cycle_hours, 2), 'hours', 1.0,
    case when avg_cycle_hours >= 0.8 then 'good' else 'warning' end from wide
  union all select unit_id, 'Filtration Cycles per Week', cycles_per_week, 'cycles/week', null, null from wide
  union all select unit_id, 'Chemical Cleaning Frequency', coalesce(cleanings_per_week, 0), 'cleanings/week', null, null from wide
  union all select unit_id, 'Current TMP', round_even(current_tmp, 2), 'bar', 6.0,
    case when current_tmp < 4.8 then 'good' else 'warning' end from wide
  union all select unit_id, 'Reversible Fouling Rate', round_even(reversible_rate, 4), 'bar/day', null, null from wide
  union all select unit_id, 'Irreversible Fouling Rate', round_even(irreversible_rate, 4), 'bar/day', null, null from wide)"""


def kpis(spark, sf):
    return prepared(
        spark, sf, "kpis",
        lambda: k.kpi_table(good_rows(spark, sf), cycle_table(spark, sf), cleaning_table(spark, sf), rate_table(spark, sf)),
    )


@query(
    "j8_kpi_table",
    """select unit_id, name, round(cast("value" as double), 6) as "value", unit, cast(target as double) as target, status from kpis where "value" is not null""",
    recursive(_KPIS),
)
def kpi_table(spark, sf):
    rows = k.kpi_table(good_rows(spark, sf), cycle_table(spark, sf), cleaning_table(spark, sf), rate_table(spark, sf))
    return rows.select("unit_id", "name", *rounded("value"), "unit", "target", "status")


@query(
    "j7_fouling_rate_kpis",
    """select unit_id, name, round(cast("value" as double), 6) as "value", unit from kpis where "value" is not null and name like '%Fouling Rate'""",
    recursive(_KPIS),
)
def rate_kpis(spark, sf):
    return kpis(spark, sf).filter(F.col("name").endswith("Fouling Rate")).select("unit_id", "name", *rounded("value"), "unit")


# Limits at which every kind of alert occurs in the given tables.
LIMITS = {"tmp_slope": (-1.0, 0.0), "permeability_decline": (-100.0, 0.0)}

_ALERTS = WEEK + """, slopes as (select unit_id, regr_slope(tmp, (us - 1704067200000000) / 1e6) * 3600 as slope,
    arg_max(tmp, us) as tmp from ordered where good group by 1),
known as (select unit_id, slope, tmp, baseline, (baseline - cur) / baseline * 100 as decline from slopes left join base using (unit_id)),
alerts as (
  select unit_id, 'tmp_slope' as alert_type, case when slope >= 0 then 'critical' when slope >= -1 then 'warning' end as severity,
    slope as "value", case when slope >= 0 then 0.0 else -1.0 end as threshold,
    printf('%s: TMP slope %.6f bar/hour exceeds threshold %s', case when slope >= 0 then 'CRITICAL' else 'WARNING' end, slope,
      case when slope >= 0 then '0.0' else '-1.0' end) as message from known
  union all
  select unit_id, 'permeability_decline', case when decline >= 0 then 'critical' when decline >= -100 then 'warning' end, decline,
    case when decline >= 0 then 0.0 else -100.0 end,
    printf('%s: Permeability declined %.1f%% from baseline (%.2f LMH/bar)', case when decline >= 0 then 'CRITICAL' else 'WARNING' end, decline, baseline)
    from known
  union all
  select unit_id, 'high_tmp', case when tmp >= 2 then 'warning' end, tmp, 2.0,
    printf('WARNING: TMP at %.2f bar, approaching max (8 bar). Consider cleaning.', tmp) from known)"""


def alert_rows(spark, sf):
    good = good_rows(spark, sf)
    figures = (
        tmp_slopes(good)
        .join(k.log_figures(good), "unit_id")
        .join(permeability_baseline(smoothed(spark, sf)), "unit_id", "left")
    )
    return k.alerts(figures, LIMITS, high_tmp=2.0)


@query(
    "j9_alerts",
    """select unit_id, alert_type, severity, round("value", 6) as "value", cast(threshold as double) as threshold, message from alerts where severity is not null""",
    _ALERTS,
)
def alerts(spark, sf):
    return alert_rows(spark, sf).select("unit_id", "alert_type", "severity", *rounded("value"), "threshold", "message")


@query(
    "g11_status_counts",
    """, tiles as (select unit_id, count(*) as n_kpis, count(*) filter (status = 'good') as n_good, count(*) filter (status = 'warning') as n_warning
      from kpis where "value" is not null group by 1),
    raised as (select unit_id, count(*) filter (severity = 'critical') as n_critical_alerts,
      count(*) filter (severity = 'warning') as n_warning_alerts from alerts where severity is not null group by 1)
    select unit_id, n_kpis, n_good, n_warning, coalesce(n_critical_alerts, 0) as n_critical_alerts, coalesce(n_warning_alerts, 0) as n_warning_alerts
    from tiles left join raised using (unit_id)""",
    recursive(_KPIS + _ALERTS[len(ORDERED_SQL):]),
)
def counts(spark, sf):
    return k.status_counts(kpis(spark, sf), alert_rows(spark, sf))


X = "((us - 1704067200000000) / 1e6)"


def _forecast_sql(model: str) -> str:
    y, goal = ("reading", "threshold") if model == "linear" else ("ln(reading + 0.1e0)", "ln(threshold + 0.1e0)")
    predicted = "a + b * xh" if model == "linear" else "exp(a + b * xh) - 0.1e0"
    lower, upper, r2 = (
        ("predicted - 1.96 * sd", "predicted + 1.96 * sd", "r2")
        if model == "linear"
        else ("predicted * 0.9", "predicted * 1.1", "0")
    )
    return FENCED_DAILY + f""", readings as (select unit_id, us, 'tmp' as p, tmp as reading from log where tmp is not null
  union all select unit_id, us, 'perm_tc', perm_tc from log where perm_tc is not null),
fit as (select unit_id, p, count(*) as n, regr_slope({y}, {X}) as b, regr_intercept({y}, {X}) as a, regr_r2({y}, {X}) as r2,
    sqrt(regr_syy({y}, {X}) * (1 - regr_r2({y}, {X})) / (count(*) - 2)) as sd,
    max({X}) as xl, max({X}) + 604800 as xh, max(us) as last_us, arg_max(reading, us) as current_value
  from readings group by 1, 2 having count(*) >= 100),
guess as (select fit.*, {predicted} as predicted, case when p = 'tmp' then 8e0 else stable_start * 0.6 end as threshold
  from fit left join starts using (unit_id)),
ahead as (select *, case when (p = 'tmp' and b > 0 or p = 'perm_tc' and b < 0) and ({goal} - (a + b * xl)) / b >= 0
    then ({goal} - (a + b * xl)) / b / 86400 end as days from guess),
forecasts as (select unit_id, case when p = 'tmp' then 'TMP' else 'Permeability TC' end as parameter, '{model}' as model_type,
    current_value, predicted as predicted_value, last_us + 604800000000 as horizon_us, {lower} as lower_bound, {upper} as upper_bound,
    {r2} as r_squared, days as time_to_threshold, threshold as threshold_value, last_us,
    case when p = 'tmp' and predicted < threshold then printf('TMP forecasted to reach %.2f bar in 7 days (within safe range)', predicted)
      when p = 'tmp' then 'WARNING: TMP forecasted to exceed 8.0 bar within 7 days'
      when threshold is null or predicted > threshold
        then printf('Permeability TC forecasted to reach %.1f LMH/bar in 7 days (within acceptable range)', predicted)
      else printf('WARNING: Permeability TC forecasted to decline to %.1f LMH/bar within 7 days', predicted) end as message
  from ahead)"""


FORECAST = _forecast_sql("linear")
_FORECAST_ROWS = """select unit_id, parameter, model_type, round(current_value, 6) as current_value, round(predicted_value, 6) as predicted_value,
  strftime(make_timestamp(horizon_us), '%Y-%m-%d %H:%M:%S.%f') as prediction_date, round(lower_bound, 6) as lower_bound,
  round(upper_bound, 6) as upper_bound, round(cast(r_squared as double), 8) as r_squared, round(threshold_value, 6) as threshold_value, message from forecasts"""


def _forecast_columns(df):
    return df.select(
        "unit_id", "parameter", "model_type", *rounded("current_value", "predicted_value"), stamp_text("prediction_date"),
        *rounded("lower_bound", "upper_bound"), *rounded("r_squared", digits=8), *rounded("threshold_value"), "message",
    )


def forecasts(spark, sf, model="linear"):
    return forecast(sensor_log(spark, sf), model, critical=stable_start(daily_points(spark, sf)))


@query("j10_linear_forecast", _FORECAST_ROWS, FORECAST)
def linear(spark, sf):
    return _forecast_columns(forecasts(spark, sf))


@query("j11_exponential_forecast", _FORECAST_ROWS, _forecast_sql("exponential"))
def exponential(spark, sf):
    return _forecast_columns(forecasts(spark, sf, "exponential"))


_DAYS_ROWS = """select unit_id, parameter, round(time_to_threshold, 3) as time_to_threshold,
  strftime(make_timestamp(last_us + cast(round(time_to_threshold * 86400e6) as bigint)), '%Y-%m-%d') as threshold_date from forecasts"""


@query("j12_time_to_threshold", _DAYS_ROWS, FORECAST)
def days_linear(spark, sf):
    return forecasts(spark, sf).select(
        "unit_id", "parameter", *rounded("time_to_threshold", digits=3),
        F.date_format("threshold_date", "yyyy-MM-dd").alias("threshold_date"),
    )


@query(
    "g13_value_range",
    """select unit_id, round(min(tmp), 6) as lowest, round(max(tmp), 6) as highest, round(min(tmp) * 0.7, 6) as axis_low,
      round(max(tmp) * 1.3, 6) as axis_high from log group by 1""",
    LOG_SQL,
)
def ranges(spark, sf):
    return value_range(sensor_log(spark, sf), "tmp").select("unit_id", *rounded("lowest", "highest", "axis_low", "axis_high"))
