"""A full batch run: from raw log rows to every result table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.functions import scalars as s
from permeate.functions.missing import nan_to_null
from permeate.operators import charts, kpis, prepare
from permeate.operators.cycles import (
    chemical_cleanings,
    cycle_metrics,
    cycle_statistics,
    cycles_by_events,
    fouling_rates,
    label_cycles,
    merge_events,
    timer_events,
    tmp_drops,
)
from permeate.operators.forecast import choose_model, forecast
from permeate.operators.fouling import add_decline, daily_low, fenced_daily_low, permeability_baseline, stable_start, tmp_slopes
from permeate.operators.learning import tree_forecast
from permeate.operators.ordering import UNIT, row_index
from permeate.operators.quality import band_filter, require_columns, stamp_gaps, validation_report
from permeate.operators.rolling import derivatives, moving_average, rolling_slopes, time_statistics
from permeate.schema import ALERT_LIMITS, REQUIRED, TARGETS, bands_for
from permeate.sources.tables import save_json, save_parquet

ANALYSED = ("tmp", "perm_tc", "flux", "recovery")


@dataclass(frozen=True)
class Settings:
    """The defaults of the analysis."""

    max_gap_minutes: float = 5
    start: str | None = None
    fill_method: str = "forward_fill"
    average_rows: int = 50
    max_points: int = 10_000
    windows: tuple[str, ...] = ("6h", "12h", "24h")
    reference_temperature: float = 10.0
    baseline_start: str | None = None
    min_cycle_minutes: float = 30
    drop_percent: float = 4
    drop_minutes: int = 10
    merge_rows: int = 100
    forecast_model: str = "linear"
    forecast_days: float = 7
    forecast_start: str | None = None
    confidence: float = 0.95
    targets: dict = field(default_factory=lambda: dict(TARGETS))
    alert_limits: dict = field(default_factory=lambda: dict(ALERT_LIMITS))


def scalar_features(df: DataFrame, reference_c: float) -> DataFrame:
    """Temperature-normalised readings and efficiencies, where their inputs exist."""
    c, have = F.col, set(df.columns)
    new = {}
    if {"perm_tc", "temp_c"} <= have:
        new["permeability_normalized"] = s.at_reference_temperature(c("perm_tc"), c("temp_c"), reference_c)
    if {"flux", "temp_c"} <= have:
        new["flux_normalized"] = s.at_reference_temperature(c("flux"), c("temp_c"), reference_c)
    if {"perm_tc", "tmp"} <= have:
        new["hydraulic_efficiency"] = s.hydraulic_efficiency(c("perm_tc"), c("tmp"))
    if {"v_crossflow", "tmp"} <= have:
        new["crossflow_efficiency"] = s.crossflow_efficiency(c("v_crossflow"), c("tmp"))
    if {"recovery", "specific_power"} <= have:
        new["recovery_per_energy"] = s.recovery_per_energy(c("recovery"), c("specific_power"))
    return df.withColumns(new)


def run(log: DataFrame, out: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Write every table below ``out`` and return them, read back, by name.

    ``log`` needs unit_id, ts, us, seq and the readings.  Each stage starts from the written
    table of the one before, so a failure repeats one stage only.
    """
    spark = log.sparkSession
    tables: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame, as_json: bool = False) -> DataFrame:
        path = f"{out}/{name}"
        save_parquet(df, path)
        tables[name] = spark.read.parquet(path)
        if as_json:
            save_json(tables[name], f"{path}.json")
        return tables[name]

    require_columns(log, REQUIRED)
    bands = bands_for(log.columns)
    raw = put("raw", row_index(nan_to_null(log)))

    readings = [c for c in raw.columns if c not in ("unit_id", "ts", "us", "seq", "rn")]
    put("validation_report", validation_report(raw, bands, readings, settings.max_gap_minutes), True)
    put("gaps", stamp_gaps(raw, settings.max_gap_minutes))

    good = band_filter(raw, bands, UNIT).select("unit_id", "ts", "us", "seq", *bands)
    if settings.start:
        good = good.filter(F.col("ts") >= F.lit(settings.start).cast("timestamp_ntz"))
    valid = put("valid", row_index(good))
    filled = prepare.fill_gaps(valid, list(bands), settings.fill_method, settings.max_gap_minutes)
    processed = put("processed", moving_average(filled, list(bands), settings.average_rows))
    put("chart_series", charts.series(processed, list(bands), settings.max_points, settings.average_rows))

    analysed = [c for c in ANALYSED if c in bands]
    changed = derivatives(processed, analysed)
    stats = time_statistics(changed, analysed, settings.windows)
    features = put("features", scalar_features(stats, settings.reference_temperature))

    sloped = rolling_slopes(features, "tmp", settings.windows)
    fouled = put("fouling", add_decline(sloped, "perm_tc", "7d", settings.baseline_start))
    slopes = put("tmp_slopes", tmp_slopes(processed))
    baseline = put("baseline", permeability_baseline(processed, "perm_tc", settings.baseline_start), True)

    if "program" in raw.columns:
        labels = put("cycle_rows", label_cycles(raw, bands, settings.min_cycle_minutes, start=settings.start))
        cycles = put("cycles", cycle_metrics(labels.filter("cycle_id > 0"), ["unit_id", "cycle_id"]), True)
        cleanings = put("cleanings", chemical_cleanings(raw), True)
    else:
        drops = tmp_drops(processed, settings.drop_percent, settings.drop_minutes)
        timer = timer_events(processed) if "chemical_timer" in processed.columns else drops.filter(F.lit(False))
        events = put("events", merge_events(drops, timer, settings.merge_rows))
        cycles = put("cycles", cycles_by_events(processed, events, settings.min_cycle_minutes / 60.0), True)
        cleanings = put(
            "cleanings", drops.filter(F.lit(False)).select("unit_id", "us", "seq", "rn").withColumn("cleaning_time", F.lit(None).cast("timestamp_ntz"))
        )
    put("cycle_statistics", cycle_statistics(cycles))
    rates = put("fouling_rates", fouling_rates(cycles, cleanings), True)

    kpi_rows = put("kpis", kpis.kpi_table(fouled, cycles, cleanings, rates, settings.targets), True)
    figures = slopes.join(kpis.log_figures(fouled), "unit_id").join(baseline, "unit_id", "left")
    alert_rows = put("alerts", kpis.alerts(figures, settings.alert_limits), True)
    put("status_counts", kpis.status_counts(kpi_rows, alert_rows))

    daily = put("daily_low", daily_low(processed))
    points = put("daily_points", fenced_daily_low(processed))
    starts = put("stable_start", stable_start(points))
    model = choose_model(settings.forecast_model, "tmp")
    if model.startswith("ml_"):
        ahead = tree_forecast(processed, "tmp", model[3:], settings.forecast_days, confidence=settings.confidence)
    else:
        ahead = forecast(
            processed, model, settings.forecast_days, settings.confidence, settings.forecast_start, critical=starts
        )
    forecasts = put("forecasts", ahead, True)

    start_points = put("cycle_start_points", charts.cycle_start_points(cycles))
    put("daily_trend", charts.trend_points(daily, "daily_value"))
    tmp_ahead = forecasts.filter(F.lower("parameter") == "tmp")
    put("forecast_path", charts.forecast_path(start_points, "tmp_start", tmp_ahead))
    put("cleaning_markers", charts.cleaning_markers(cleanings, start_points, "tmp_start"))
    put("tmp_note", charts.tmp_note(start_points, rates))
    put("decline_note", charts.decline_note(points, starts))
    put("cycle_comparison", charts.cycle_comparison(cycles))
    return tables
