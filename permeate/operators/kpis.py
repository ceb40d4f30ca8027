"""Key figures, alerts and summary counts per unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.functions.missing import ratio
from permeate.functions.scalars import half_even
from permeate.functions.timing import span
from permeate.operators.ordering import UNIT
from permeate.schema import ALERT_LIMITS, HIGH_TMP, TARGETS

_PLACE = ("us", "seq")


def log_figures(rows: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Means and last readings of the log: one scan, one row per unit."""
    return rows.groupBy(*keys).agg(
        F.avg("recovery").alias("avg_recovery"),
        F.avg("specific_power").alias("avg_specific_power"),
        F.max_by("tmp", F.struct(*_PLACE)).alias("current_tmp"),
        F.max("us").alias("last_us"),
    )


def per_week(n: Column, first_us: Column, last_us: Column) -> Column:
    """Events per week between two instants; 0 where no time passed."""
    days = span(first_us, last_us, "days")
    return F.when(days > 0, ratio(n, days / 7.0)).otherwise(0.0)


def cycle_figures(cycles: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    return cycles.groupBy(*keys).agg(
        F.avg("duration_hours").alias("avg_cycle_hours"),
        F.when(
            F.count("*") > 1, per_week(F.count("*"), F.min("start_us"), F.max("end_us"))
        ).alias("cycles_per_week"),
    )


def cleaning_figures(cleanings: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    weekly = F.when(F.count("*") > 1, per_week(F.count("*"), F.min("us"), F.max("us"))).otherwise(0.0)
    return cleanings.groupBy(*keys).agg(half_even(weekly, 0).alias("cleanings_per_week"))


def _good_if(condition: Column) -> Column:
    return F.when(condition, "good").otherwise("warning")


def kpi_table(
    rows: DataFrame,
    cycles: DataFrame,
    cleanings: DataFrame,
    rates: DataFrame,
    targets: dict[str, float] = TARGETS,
    keys: Sequence[str] = UNIT,
) -> DataFrame:
    """All key figures, one row per unit and figure; the log itself is read once."""
    keys = list(keys)
    wide = (
        log_figures(rows, keys)
        .join(cycle_figures(cycles, keys), keys, "left")
        .join(cleaning_figures(cleanings, keys), keys, "left")
        .join(rates.select(*keys, "reversible_rate", "irreversible_rate"), keys, "left")
    )
    c, lit = F.col, F.lit
    none = lit(None).cast("double")

    def kpi(name: str, value: Column, unit: str, target: Column = none, status: Column | None = None):
        return F.struct(
            lit(name).alias("name"),
            value.cast("double").alias("value"),
            lit(unit).alias("unit"),
            target.alias("target"),
            (status if status is not None else lit(None).cast("string")).alias("status"),
        )

    goal = {k: lit(float(v)) for k, v in targets.items()}
    figures = F.array(
        kpi("Average Recovery Rate", c("avg_recovery"), "%", goal["recovery"],
            _good_if(c("avg_recovery") >= goal["recovery"])),
        kpi("Average Specific Energy", half_even(c("avg_specific_power"), 2), "kWh/m³",
            goal["specific_energy"], _good_if(c("avg_specific_power") <= goal["specific_energy"])),
        kpi("Average Cycle Duration", half_even(c("avg_cycle_hours"), 2), "hours", goal["cycle_hours"],
            _good_if(c("avg_cycle_hours") >= goal["cycle_hours"] * 0.8)),
        kpi("Filtration Cycles per Week", c("cycles_per_week"), "cycles/week"),
        kpi("Chemical Cleaning Frequency", F.coalesce("cleanings_per_week", lit(0.0)), "cleanings/week"),
        kpi("Current TMP", half_even(c("current_tmp"), 2), "bar", goal["tmp_max"],
            _good_if(c("current_tmp") < goal["tmp_max"] * 0.8)),
        kpi("Reversible Fouling Rate", half_even(c("reversible_rate"), 4), "bar/day"),
        kpi("Irreversible Fouling Rate", half_even(c("irreversible_rate"), 4), "bar/day"),
    )
    return (
        wide.select(*keys, F.explode(figures).alias("_kpi"))
        .select(*keys, "_kpi.*")
        .filter(F.col("value").isNotNull())
    )


def alerts(
    figures: DataFrame,
    limits: dict[str, tuple[float, float]] = ALERT_LIMITS,
    high_tmp: float = HIGH_TMP,
    keys: Sequence[str] = UNIT,
) -> DataFrame:
    """Alerts from per-unit figures: slope_per_hour, permeability_decline_baseline,
    permeability_baseline and current_tmp.  Only a rising TMP raises a slope alert."""
    c = F.col

    def level(value: Column, warn: float, crit: float) -> Column:
        return F.when(value >= crit, "critical").when(value >= warn, "warning")

    def limit(value: Column, warn: float, crit: float) -> Column:
        return F.when(value >= crit, F.lit(crit)).otherwise(F.lit(warn))

    def alert(kind: str, severity: Column, value: Column, threshold: Column, message: Column):
        return F.struct(
            F.lit(kind).alias("alert_type"),
            severity.alias("severity"),
            value.alias("value"),
            threshold.alias("threshold"),
            message.alias("message"),
        )

    slope, decline, tmp = c("slope_per_hour"), c("permeability_decline_baseline"), c("current_tmp")
    s_warn, s_crit = limits["tmp_slope"]
    d_warn, d_crit = limits["permeability_decline"]
    # Message formats.
    slope_text = "%s: TMP slope %.6f bar/hour exceeds threshold %s"
    decline_text = "%s: Permeability declined %.1f%% from baseline (%.2f LMH/bar)"
    tmp_text = "WARNING: TMP at %.2f bar, approaching max (8 bar). Consider cleaning."
    candidates = F.array(
        alert("tmp_slope", level(slope, s_warn, s_crit), slope, limit(slope, s_warn, s_crit),
              F.format_string(slope_text, F.upper(level(slope, s_warn, s_crit)), slope,
                              limit(slope, s_warn, s_crit).cast("string"))),
        alert("permeability_decline", level(decline, d_warn, d_crit), decline, limit(decline, d_warn, d_crit),
              F.format_string(decline_text, F.upper(level(decline, d_warn, d_crit)), decline,
                              c("permeability_baseline"))),
        alert("high_tmp", F.when(tmp >= high_tmp, "warning"), tmp, F.lit(high_tmp),
              F.format_string(tmp_text, tmp)),
    )
    return (
        figures.select(*keys, F.explode(candidates).alias("_alert"))
        .select(*keys, "_alert.*")
        .filter(F.col("severity").isNotNull())
    )


def status_counts(kpis: DataFrame, alert_rows: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Numbers for the summary tiles: good and warning KPIs, alerts by severity."""
    keys = list(keys)
    tiles = kpis.groupBy(*keys).agg(
        F.count("*").alias("n_kpis"),
        F.count_if(F.col("status") == "good").alias("n_good"),
        F.count_if(F.col("status") == "warning").alias("n_warning"),
    )
    raised = alert_rows.groupBy(*keys).agg(
        F.count_if(F.col("severity") == "critical").alias("n_critical_alerts"),
        F.count_if(F.col("severity") == "warning").alias("n_warning_alerts"),
    )
    return tiles.join(raised, keys, "left").na.fill(0, ["n_critical_alerts", "n_warning_alerts"])
