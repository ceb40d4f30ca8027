"""Filtration cycles: runs of the filtration program, cleanings, per-cycle metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.functions.missing import ratio
from permeate.functions.regression import fit_lines, r_squared, seconds
from permeate.functions.timing import DAY, HOUR, MINUTE, span, to_stamp
from permeate.operators.folds import first_takers, keep_apart
from permeate.operators.ordering import UNIT, frames, own_rows, row_index, running
from permeate.operators.quality import Bands, in_band, sensors_of_units
from permeate.operators.quantiles import fence
from permeate.operators.rolling import edges, increments
from permeate.schema import CHEMICAL_CLEANING, FILTRATION
from permeate.storage import attach, stage


def mark_periods(
    ordered: DataFrame,
    program: int = FILTRATION,
    keys: Sequence[str] = UNIT,
    carried: dict[str, tuple[str, str | Column]] | None = None,
    **blocks,
) -> DataFrame:
    """Add to each row the period it belongs to, and the values ``carried`` by the same :func:`running`.

    ``period`` is the row number of the period's first row.  A period is a longest run of the
    program plus the one row after it, which closes it; NULL outside.  ``in_run`` is false on the
    closing row.  ``next_us`` is the stamp of the following row.
    """
    near, w = frames(
        ordered.withColumn("in_run", F.col("program").eqNullSafe(program)), 1, 1, keys=keys, **blocks
    )
    was = F.coalesce(F.lag("in_run").over(w), F.lit(False))
    marked = own_rows(
        near.withColumns(
            {
                "_opens": F.when(F.col("in_run") & ~was, F.col("rn")),
                "_member": F.col("in_run") | was,
                "next_us": F.coalesce(F.lead("us").over(w), F.col("us")),
            }
        )
    )
    return running(marked, {"period": ("last", "_opens"), **(carried or {})}, keys=keys, **blocks).withColumn(
        "period", F.when(F.col("_member"), F.col("period"))
    ).drop("_opens", "_member")


def filtration_periods(
    ordered: DataFrame, program: int = FILTRATION, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Start and end of each run; the end is the first row after it, or the last row of the log."""
    keys = list(keys)
    narrow = ordered.select(*keys, "us", "seq", "rn", "program")
    return (
        mark_periods(narrow, program, keys, **blocks)
        .filter("in_run")
        .groupBy(*keys, "period")
        .agg(
            F.min("us").alias("start_us"),
            F.max("next_us").alias("end_us"),
            F.count("*").alias("n_rows"),
        )
    )


def chemical_cleanings(
    ordered: DataFrame, program: int = CHEMICAL_CLEANING, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Rows at which the cleaning program starts, with their stamp."""
    narrow = ordered.select(*keys, "us", "seq", "rn", "program")
    return (
        edges(narrow, F.col("program") == program, keys, **blocks)
        .filter("rising")
        .select(*keys, "us", "seq", "rn", to_stamp(F.col("us")).alias("cleaning_time"))
    )


def tmp_drops(
    ordered: DataFrame,
    threshold_percent: float = 4,
    window_minutes: int = 10,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Rows at which TMP first falls clearly below its recent maximum.

    The frame is ``window_minutes // 5`` rows, as the analysis has always counted it.
    """
    rows = max(window_minutes // 5, 1)
    near, w = frames(ordered.select(*keys, "us", "seq", "rn", "tmp"), rows - 1, keys=keys, **blocks)
    peak = F.max("tmp").over(w.rowsBetween(-(rows - 1), 0))
    dropped = own_rows(near.withColumn("drop_percent", ratio(peak - F.col("tmp"), peak) * 100.0))
    return edges(dropped, F.col("drop_percent") > threshold_percent, keys, **blocks).filter("rising").drop(
        "rising", "falling"
    )


def timer_events(ordered: DataFrame, keys: Sequence[str] = UNIT, **blocks) -> DataFrame:
    """Rows at which the chemical timer went up."""
    return increments(ordered.select(*keys, "us", "seq", "rn", "chemical_timer"), "chemical_timer", keys, **blocks)


def merge_events(
    first: DataFrame, second: DataFrame, distance: int = 100, keys: Sequence[str] = UNIT, **sizes
) -> DataFrame:
    """Distinct positions of both lists, greedily thinned to be more than ``distance`` apart."""
    both = first.select(*keys, "rn").unionByName(second.select(*keys, "rn")).distinct()
    return keep_apart(both, distance, "rn", keys, **sizes)


def _metrics(n: Column) -> dict[str, Column]:
    """Per-cycle aggregates; rows carry ``k`` (1, 2, … in the cycle) and the cycle length ``n``."""
    long = n > 10
    from_end = n - F.col("k") + 1
    first = lambda c: F.min_by(c, "k")
    last = lambda c: F.max_by(c, "k")
    start = F.median(F.when(long & F.col("k").between(11, 60), F.col("tmp")))
    end = F.median(F.when(long & from_end.between(11, 50), F.col("tmp")))
    x = seconds(F.col("us"))
    perm_first, perm_last = first("perm_tc"), last("perm_tc")
    return {
        "_from": F.min("us"),
        "_to": F.max("us"),
        "n_rows": F.count("*"),
        "tmp_start": F.coalesce(start, first("tmp")),
        "tmp_end": F.coalesce(end, last("tmp")),
        "tmp_slope": F.regr_slope("tmp", x) * 3600.0,
        "tmp_slope_r2": r_squared(F.col("tmp"), x),
        "permeability_start": perm_first,
        "permeability_end": perm_last,
        "permeability_decline_percent": F.when(
            perm_first > 0, ratio(perm_first - perm_last, perm_first) * 100.0
        ).otherwise(0.0),
    }


def _averages(columns: Sequence[str]) -> dict[str, Column]:
    names = {"flux": "avg_flux", "recovery": "avg_recovery", "mem_retention": "avg_retention"}
    return {out: F.avg(c) for c, out in names.items() if c in columns}


def cycle_metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cycle table from rows that carry the cycle keys, ``k`` and ``n``; one aggregation.

    At most 50 values per side enter a median, however long a cycle is.
    """
    out = rows.groupBy(*keys).agg(
        *[c.alias(name) for name, c in {**_metrics(F.col("n")), **_averages(rows.columns)}.items()]
    )
    return out.select(
        *keys,
        to_stamp(F.col("_from")).alias("start_time"),
        to_stamp(F.col("_to")).alias("end_time"),
        F.col("_from").alias("start_us"),
        F.col("_to").alias("end_us"),
        span(F.col("_from"), F.col("_to")).alias("duration_hours"),
        *[c for c in out.columns if c not in (*keys, "_from", "_to")],
    )


def label_cycles(
    ordered: DataFrame,
    bands: Bands,
    min_minutes: float = 30,
    min_rows: int = 10,
    program: int = FILTRATION,
    keys: Sequence[str] = UNIT,
    start: str | None = None,
    **blocks,
) -> DataFrame:
    """Plausible rows of the log with ``cycle_id`` (0 outside), ``k`` and ``n`` inside the cycle.

    Only rows from the stamp ``start`` on can be members.

    Periods and their duration come from the raw rows, membership and lengths from the plausible
    ones.  A cycle needs ``min_minutes`` of raw time and ``min_rows`` plausible rows; the cycles
    kept are numbered 1, 2, … in time order per unit.
    """
    keys = list(keys)
    sensors = sensors_of_units(ordered, list(bands), keys).withColumnRenamed("sensors", "_sensors")
    ordered = attach(ordered, sensors, keys)
    member = in_band(bands, F.col("_sensors"))
    if start:
        member = member & (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    marked = mark_periods(
        ordered.withColumn("_good", member).drop("_sensors").withColumn("_one", F.col("_good").cast("long")),
        program,
        keys,
        carried={"_good_no": ("sum", "_one")},
        **blocks,
    )
    counted = stage(marked.drop("_one"), "periods")
    inside = counted.filter(F.col("period").isNotNull())
    kept = (
        inside.groupBy(*keys, "period")
        .agg(
            F.min(F.when(F.col("in_run"), F.col("us"))).alias("_raw_from"),
            F.max(F.when(F.col("in_run"), F.col("next_us"))).alias("_raw_to"),
            F.min(F.when(F.col("_good"), F.col("_good_no"))).alias("_first_no"),
            F.count_if("_good").alias("n"),
        )
        .filter(
            (F.col("_raw_to") - F.col("_raw_from") >= int(min_minutes * MINUTE))
            & (F.col("n") >= min_rows)
        )
    )
    numbered = row_index(kept, keys, ["period"], index="_no", name="cycles").select(
        *keys, "period", "n", "_first_no", (F.col("_no") + 1).alias("cycle_id")
    )
    return (
        attach(counted.filter("_good"), numbered, [*keys, "period"], "left")
        .withColumn("k", F.col("_good_no") - F.col("_first_no") + 1)
        .withColumn("cycle_id", F.coalesce("cycle_id", F.lit(0)).cast("int"))
        .drop("_good", "_good_no", "_first_no", "period", "in_run", "next_us")
    )


def cycles_by_program(
    ordered: DataFrame,
    bands: Bands,
    min_minutes: float = 30,
    min_rows: int = 10,
    program: int = FILTRATION,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    rows = label_cycles(ordered, bands, min_minutes, min_rows, program, keys, **blocks)
    return cycle_metrics(rows.filter("cycle_id > 0"), [*keys, "cycle_id"])


def label_segments(
    ordered: DataFrame,
    events: DataFrame,
    min_hours: float = 0.5,
    min_rows: int = 10,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Rows with the segment between events they lie in: ``cycle_id``, ``k`` and ``n``.

    Only segments with enough rows and time are numbered, others have id 0.  A unit without any
    event is one segment that ends before its last row; all its rows carry id 1.
    """
    keys = list(keys)
    marks = events.select(*keys, "rn", F.lit(1).alias("_event"))
    with_events = ordered.join(marks, [*keys, "rn"], "left").withColumn(
        "_opens", F.when((F.col("rn") == 0) | F.col("_event").isNotNull(), F.col("rn"))
    )
    counted = stage(
        running(with_events, {"_segment": ("last", "_opens")}, keys=keys, **blocks).drop("_opens"),
        "segments",
    )
    units = counted.groupBy(*keys).agg(
        F.count("_event").alias("_events"), F.max("rn").alias("_last_rn")
    )
    parts = (
        counted.join(units, keys)
        .withColumn(
            "_segment",
            F.when((F.col("_events") == 0) & (F.col("rn") == F.col("_last_rn")), F.col("rn")).otherwise(
                F.col("_segment")
            ),
        )
        .drop("_event", "_last_rn")
    )
    kept = (
        parts.groupBy(*keys, "_segment")
        .agg(F.count("*").alias("n"), F.min("us").alias("_from"), F.max("us").alias("_to"))
        .filter((F.col("n") >= min_rows) & (span(F.col("_from"), F.col("_to")) >= min_hours))
    )
    numbered = row_index(kept, keys, ["_segment"], index="_no", name="cycles").select(
        *keys, "_segment", "n", (F.col("_no") + 1).cast("int").alias("_id")
    )
    return (
        parts.join(numbered, [*keys, "_segment"], "left")
        .withColumn("k", F.when(F.col("_id").isNotNull(), F.col("rn") - F.col("_segment") + 1))
        .withColumn(
            "cycle_id",
            F.coalesce("_id", F.when(F.col("_events") == 0, F.lit(1)).otherwise(F.lit(0))),
        )
        .drop("_segment", "_id", "_events")
    )


def cycles_by_events(
    ordered: DataFrame,
    events: DataFrame,
    min_hours: float = 0.5,
    min_rows: int = 10,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    rows = label_segments(ordered, events, min_hours, min_rows, keys, **blocks)
    return cycle_metrics(rows.filter(F.col("k").isNotNull()), [*keys, "cycle_id"])


def find_cycles(
    ordered: DataFrame,
    bands: Bands,
    min_minutes: float = 30,
    use_program: bool = True,
    drop_percent: float = 4,
    drop_minutes: int = 10,
    merge_rows: int = 100,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Cycles by program number where the log has one, else by TMP drops and chemical timer.

    The second way works on the plausible rows only, numbered anew.
    """
    if use_program and "program" in ordered.columns:
        return cycles_by_program(ordered, bands, min_minutes, keys=keys, **blocks)
    good = stage(row_index(ordered.filter(in_band(bands)).drop("rn"), keys, name="plausible"), "plausible")
    drops = tmp_drops(good, drop_percent, drop_minutes, keys, **blocks)
    timer = (
        timer_events(good, keys, **blocks)
        if "chemical_timer" in good.columns
        else drops.filter(F.lit(False))
    )
    events = merge_events(drops, timer, merge_rows, keys)
    return cycles_by_events(good, events, min_minutes / 60.0, keys=keys, **blocks)


def cycle_statistics(cycles: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    return cycles.groupBy(*keys).agg(
        F.count("*").alias("n_cycles"),
        F.avg("duration_hours").alias("avg_duration_hours"),
        F.avg("tmp_slope").alias("avg_tmp_slope"),
        F.avg("permeability_decline_percent").alias("avg_permeability_decline"),
    )


def post_cleaning_cycles(
    cycles: DataFrame, cleanings: DataFrame, hours: float = 3, keys: Sequence[str] = UNIT, **sizes
) -> DataFrame:
    """First cycle within ``hours`` after each cleaning; one cycle serves one cleaning."""
    takers = cycles.filter(F.col("tmp_start").isNotNull()).select(
        *keys, F.col("start_us").alias("us"), "cycle_id", "tmp_start"
    )
    return first_takers(
        cleanings, takers, int(hours * HOUR), keys, item_tie="seq", taker_tie="cycle_id", **sizes
    ).withColumnsRenamed({"us": "start_us", "item_us": "cleaning_us"})


def fouling_rates(
    cycles: DataFrame, cleanings: DataFrame, hours: float = 3, keys: Sequence[str] = UNIT, **sizes
) -> DataFrame:
    """Slopes of cycle-start TMP in bar/day: all cycles (fenced) and post-cleaning cycles.

    NULL where fewer than two cycles support a slope.
    """
    keys = list(keys)
    starts = stage(cycles.select(*keys, "cycle_id", "start_us", "tmp_start"), "starts")
    fenced = fence(starts, "tmp_start", keys, tie=("cycle_id",))
    all_cycles = fit_lines(fenced.filter("inside"), "tmp_start", keys, "start_us")
    cleaned = fit_lines(
        post_cleaning_cycles(starts, cleanings, hours, keys, **sizes), "tmp_start", keys, "start_us"
    )
    day = DAY / 1e6
    counts = starts.groupBy(*keys).agg(F.count("tmp_start").alias("total_cycles"))
    return (
        counts.join(
            all_cycles.select(
                *keys,
                F.col("n").alias("valid_cycles"),
                F.when(F.col("n") >= 2, F.col("slope") * day).alias("reversible_rate"),
                F.when(F.col("n") >= 2, F.col("r_squared")).alias("reversible_r_squared"),
            ),
            keys,
            "left",
        )
        .join(
            cleaned.select(
                *keys,
                F.col("n").alias("post_cleaning_cycles"),
                F.when(F.col("n") >= 2, F.col("slope") * day).alias("irreversible_rate"),
                F.when(F.col("n") >= 2, F.col("r_squared")).alias("irreversible_r_squared"),
            ),
            keys,
            "left",
        )
        .withColumn("valid_cycles", F.coalesce("valid_cycles", F.lit(0)))
        .withColumn("outliers_removed", F.col("total_cycles") - F.col("valid_cycles"))
        .withColumn(
            "post_cleaning_cycles",
            F.when(F.col("valid_cycles") >= 2, F.coalesce("post_cleaning_cycles", F.lit(0))).otherwise(0),
        )
    )
