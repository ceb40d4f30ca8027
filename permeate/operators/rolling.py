"""Derivatives, moving statistics over time and over rows, edges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from permeate.functions.missing import finite, ratio
from permeate.functions.timing import HOUR, SECOND, width
from permeate.operators.ordering import TASK_ROWS, UNIT, frames, ordered_pieces, own_rows, running, task_count
from permeate.storage import attach

# Moments are held as mergeable triples (count, mean, sum of squared deviations): a frame is cut
# into at most two parts that each grow from a fixed end, Spark's window aggregates fold each part
# row by row (Welford's update), and the two parts are joined by Chan's formula.  No row is ever
# taken out of a sum again, so nothing cancels, nothing overflows a fixed scale, and every finite
# reading counts however far it lies from the others.

_EVENT = ("_at", "_slot", "_kind", "_place", "_piece")


def derivatives(
    ordered: DataFrame, columns: Sequence[str], keys: Sequence[str] = UNIT, suffix: str = "_derivative", **blocks
) -> DataFrame:
    """Change per hour since the previous row; NULL where no time has passed."""
    near, w = frames(ordered, 1, keys=keys, **blocks)
    hours = (F.col("us") - F.lag("us").over(w)) / F.lit(float(HOUR))
    return own_rows(
        near.withColumns({f"{c}{suffix}": ratio(F.col(c) - F.lag(c).over(w), hours) for c in columns})
    )


def _moments(value: Column, w: WindowSpec) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared deviations of ``value`` over the frame ``w``; 0, 0, 0 when empty."""
    n = F.count(value).over(w)
    # The mean is taken from the frame's first reading, so equal readings have exactly their mean.
    first = F.first(value, ignorenulls=True).over(w)
    mean = first + F.avg(value - first).over(w)
    return n, F.coalesce(mean, F.lit(0.0)), F.coalesce(F.var_pop(value).over(w) * n, F.lit(0.0))


def _joined(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """The triple of two disjoint parts (Chan, Golub and LeVeque); an empty part changes nothing."""
    (na, ma, qa), (nb, mb, qb) = a, b
    n = na + nb
    share = F.when(n > 0, nb.cast("double") / n).otherwise(F.lit(0.0))
    d = mb - ma
    return n, ma + d * share, qa + qb + d * d * na.cast("double") * share


def _forms(n: Column, mean: Column, squares: Column) -> dict[str, Column]:
    """Mean (rows > 0) and sample deviation (rows > 1); a deviation beyond the range of doubles is infinite."""
    return {
        "mean": F.when(n > 0, mean),
        "std": F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1).cast("double"))),
    }


def _with_expiries(df: DataFrame, widths: Sequence[int], values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Each row, plus one event per window at the instant the row leaves that window.

    A window is ``(t - w, t]``, so an expiry comes before a row of the same instant.
    """
    slots = F.array(
        F.struct(F.col("us").alias("_at"), F.lit(-1).alias("_slot")),
        *[F.struct((F.col("us") + w).alias("_at"), F.lit(i).alias("_slot")) for i, w in enumerate(widths)],
    )
    events = df.select("*", F.explode(slots).alias("_event")).select("*", "_event.*").drop("_event")
    is_row = F.col("_slot") == -1
    kept = {*keys, *values, "us", "seq"}
    events = events.withColumns(
        {c: F.when(is_row, F.col(c)) for c in df.columns if c not in kept}
    ).withColumn("_kind", is_row.cast("int"))
    return ordered_pieces(events, keys, ("_at", "_kind", "seq"), "windows")


def _span(us: Column, wide: int) -> Column:
    """Number of the span of ``wide`` microseconds that holds ``us``, in integers (floors negatives)."""
    return ((us - F.pmod(us, F.lit(wide))) / F.lit(wide)).cast("long")


def time_statistics(
    df: DataFrame,
    columns: Sequence[str],
    windows: Sequence[str] = ("6h", "12h", "24h"),
    statistics: Sequence[str] = ("mean", "std"),
    keys: Sequence[str] = UNIT,
) -> DataFrame:
    """Mean and sample deviation over the last 6/12/24 hours, ``(t - w, t]``, missing skipped.

    Time is cut into spans of one window width, so a window holds the tail of the span before
    its row and the head of its own span up to the row.  The head is a growing frame in time
    order; the tail is a growing frame in reverse order, read off at a probe placed at ``t - w``.
    Rows are told apart by (keys, us, seq), the order the series already needs; NaN and infinite
    readings are missing, every finite one counts.  A span of many rows is cut into pieces; the
    triples of its other pieces are joined to the frame in each (:func:`_carried`), so the memory
    of a task does not grow with the rows of a unit or a span.
    """
    keys, spark = list(keys), df.sparkSession
    widths = [width(w) for w in windows]
    narrow = df.select(*keys, "us", "seq", *[finite(F.col(c)).alias(f"_v_{c}") for c in columns])
    n_rows = narrow.count()
    n_events = 2 * len(widths) * n_rows
    # All events of a row meet in one task at the end; rows are dealt out that way before they are
    # multiplied, too, so that no task makes the events of a whole input split.
    met = [task_count(spark, n_rows), *keys, "us", "seq"]
    kinds = []
    for i, wide in enumerate(widths):
        span = _span(F.col("us"), wide)
        for kind, b, at in ((0, span, F.col("us")), (1, span - 1, F.col("us") - wide)):
            kinds.append(F.struct(F.lit(i).alias("_w"), b.alias("_b"), at.alias("_at"), F.lit(kind).alias("_kind")))
    group, order = [*keys, "_w", "_b"], ["_at", "_kind", "seq"]
    values = [F.when(F.col("_e._kind") == 0, F.col(f"_v_{c}")).alias(f"_v_{c}") for c in columns]
    events = narrow.repartition(*met).withColumn("_e", F.explode(F.array(*kinds))).select(*keys, "us", "seq", "_e.*", *values)
    pieces = ordered_pieces(events, group, order, "spans", task_count(spark, n_events))
    carried = attach(pieces.drop("_place"), _carried(pieces, columns, group), [*group, "_piece"], "left")
    part = Window.partitionBy(*group, "_piece")
    head = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # A probe comes before rows of its own instant in reverse order: those lie outside the window.
    tail = part.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    moments = {}
    for c in columns:
        for name, frame in (("h", head), ("t", tail)):
            moments.update({f"_{name}{x}_{c}": e for x, e in zip("nmq", _moments(F.col(f"_v_{c}"), frame))})
    folded = carried.repartition(task_count(spark, n_events, 2 * TASK_ROWS), *group, "_piece").withColumns(moments)
    is_row, mine = F.col("_kind") == 0, []
    for c in columns:
        whole = {
            name: _carried_joined(*[[F.col(f"{p}{name}{x}_{c}") for x in "nmq"] for p in ("_carry_", "_")])
            for name in "ht"
        }
        mine += [F.when(is_row, h).otherwise(t).alias(f"_{x}_{c}") for x, h, t in zip("nmq", whole["h"], whole["t"])]
    picks = []
    for i, _ in enumerate(widths):
        for c in columns:
            for name, kind in (("h", 0), ("t", 1)):
                this = (F.col("_w") == i) & (F.col("_kind") == kind)
                picks += [F.max(F.when(this, F.col(f"_{x}_{c}"))).alias(f"_{name}{x}_{c}_{i}") for x in "nmq"]
    per_row = folded.select(*keys, "us", "seq", "_w", "_kind", *mine).repartition(*met).groupBy(*keys, "us", "seq").agg(*picks)
    out = {}
    for i, label in enumerate(windows):
        for c in columns:
            n, mean, squares = _joined(
                *[tuple(F.col(f"_{name}{x}_{c}_{i}") for x in "nmq") for name in ("t", "h")]
            )
            forms = _forms(n, mean, squares)
            out.update({f"{c}_{s}_{label}": forms[s] for s in statistics})
    stats = per_row.select(*keys, "us", "seq", *[v.alias(k) for k, v in out.items()])
    kept = df.drop(*[k for k in out if k in df.columns]).repartition(*met)
    # Both sides lie by the key already: merged where they are, neither is sent round by the driver.
    return kept.join(stats.hint("merge"), [*keys, "us", "seq"], "left")


def _carried_joined(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    """:func:`_joined` where an empty or missing part leaves the other exactly as it is."""
    return [
        F.when(F.coalesce(a[0], F.lit(0)) == 0, alone_b).when(b[0] == 0, alone_a).otherwise(both)
        for alone_a, alone_b, both in zip(a, b, _joined(tuple(a), tuple(b)))
    ]


def _carried(pieces: DataFrame, columns: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Triples of all earlier (``h``) and all later (``t``) pieces of a group, per piece of a group that is cut.

    The windows see one row per piece of a group, and only the groups that lie in several pieces.
    """
    total = []
    for c in columns:
        v = F.col(f"_v_{c}")
        mean = F.when(F.min(v) == F.max(v), F.min(v)).otherwise(F.avg(v))  # equal readings have exactly their mean
        parts = zip("nmq", (F.count(v), F.coalesce(mean, F.lit(0.0)), F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0))))
        total.append(F.struct(*[e.alias(x) for x, e in parts]).alias(f"_total_{c}"))
    by = Window.partitionBy(*group)
    totals = pieces.groupBy(*group, "_piece").agg(*total).withColumn("_pieces", F.count("*").over(by)).filter("_pieces > 1")

    def merged(a: Column, b: Column) -> Column:
        both = _carried_joined([a[x] for x in "nmq"], [b[x] for x in "nmq"])
        return F.struct(*[e.alias(x) for x, e in zip("nmq", both)])

    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))
    carries = {}
    for name, place in (("h", F.asc("_piece")), ("t", F.desc("_piece"))):
        before = by.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        for c in columns:
            carries[f"_{name}_{c}"] = F.aggregate(F.collect_list(f"_total_{c}").over(before), nothing, merged)
    fields = [F.col(f"_{name}_{c}")[x].alias(f"_carry_{name}{x}_{c}") for name in "ht" for c in columns for x in "nmq"]
    return totals.withColumns(carries).select(*group, "_piece", *fields)


def rolling_slopes(
    ordered: DataFrame,
    column: str = "tmp",
    windows: Sequence[str] = ("6h", "12h", "24h"),
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Mean over each window of the change per hour between neighbouring rows."""
    steps = derivatives(ordered, [column], keys, suffix="_step", **blocks)
    out = time_statistics(steps, [f"{column}_step"], windows, ("mean",), keys)
    return out.withColumnsRenamed(
        {f"{column}_step_mean_{w}": f"{column}_slope_{w}" for w in windows}
    ).drop(f"{column}_step")


def decline_from_window_start(
    ordered: DataFrame, column: str = "perm_tc", window: str = "7d", keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Percent decline from the first row of the window ``(t - w, t]`` to the current row.

    The expiry of a row announces its successor, which is then the first row of the window.
    """
    near, w = frames(ordered, 0, 1, keys=keys, **blocks)
    following = own_rows(
        near.withColumn("_next", F.struct(F.lead(column).over(w).alias("v")))
    )
    events = _with_expiries(following, [width(window)], [column, "_next"], keys)
    first = F.when(F.col("_slot") == 0, F.col("_next")).when(
        F.col("rn") == 0, F.struct(F.col(column).alias("v"))
    )
    rows = running(
        events.withColumn("_opens", first), {"_first": ("last", "_opens")}, keys=keys, pieces=True
    ).filter(F.col("_slot") == -1)
    start = F.col("_first")["v"]
    return rows.withColumn(
        f"{column}_decline_{window}", ratio(start - F.col(column), start) * 100.0
    ).drop("_first", "_opens", "_next", *_EVENT)


def lag_features(
    ordered: DataFrame, column: str, lags: Sequence[int] = (1, 12, 72, 144, 288), keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    near, w = frames(ordered, max(lags), keys=keys, **blocks)
    return own_rows(near.withColumns({f"{column}_lag_{k}": F.lag(column, k).over(w) for k in lags}))


def _moving_moments(
    near: DataFrame, w: WindowSpec, keys: Sequence[str], columns: Sequence[str], sizes: Sequence[int]
) -> tuple[DataFrame, list[str], dict]:
    """(count, mean, squares) over the last k rows, missing skipped.

    Rows are cut into runs of k by their number; the last k rows are the tail of the run before
    (from row i - k + 1 on) and the head of the row's own run (up to row i), each a growing frame.
    ``near`` must come from blocks of a multiple of every k that reach back k - 1 rows.
    """
    made, triples = [], {}
    for k in sizes:
        run = f"_run_{k}"
        near = near.withColumn(run, F.expr(f"rn div {k}"))
        part = Window.partitionBy(*keys, "_block", run)
        head = part.orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
        tail = part.orderBy(F.desc("rn")).rowsBetween(Window.unboundedPreceding, 0)
        for c in columns:
            v = finite(F.col(c))
            names = {f"_{p}{x}_{c}_{k}": e for p, frame in (("h", head), ("t", tail)) for x, e in zip("nmq", _moments(v, frame))}
            near = near.withColumns(names)
            made += names
            whole_run = F.col("rn") % k == k - 1  # the head alone is the whole frame
            earlier = tuple(F.coalesce(F.lag(f"_t{x}_{c}_{k}", k - 1).over(w), F.lit(0)) for x in "nmq")
            own = tuple(F.col(f"_h{x}_{c}_{k}") for x in "nmq")
            both = _joined(earlier, own)
            triples[(c, k)] = tuple(F.when(whole_run, o).otherwise(j) for o, j in zip(own, both))
        made.append(run)
    return near, made, triples


#: A block and the rows before it together stay below Spark's 4,096 rows of a window that are held
#: as plain rows: beyond them every window sets up a sorter of its own.
_WINDOW_ROWS = 4_096


def _row_blocks(sizes: Sequence[int], blocks: dict) -> dict:
    """Blocks of a multiple of every window size, at least as many rows as asked for."""
    step = math.lcm(*sizes)
    asked = blocks.get("block_rows", max(1, (_WINDOW_ROWS - max(sizes)) // step * step))
    return {**blocks, "block_rows": step * -(-asked // step)}


def _moving_extremes(near: DataFrame, w: WindowSpec, column: str, sizes: Sequence[int], kinds: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Minimum/maximum over the last k rows by doubling: the extreme of 2p rows is that of the
    last p rows and of the p rows before them, so k rows take log2(k) steps.  Missing values are
    skipped by ``least`` and ``greatest``."""
    pick = {"min": F.least, "max": F.greatest}
    reach, made, level = 1, [], {m: column for m in kinds}
    levels = {1: dict(level)}
    while reach * 2 <= max(sizes):
        level = {m: f"_{m}_{reach * 2}" for m in kinds}
        near = near.withColumns(
            {
                level[m]: F.coalesce(pick[m](F.col(p), F.lag(p, reach).over(w)), F.col(p), F.lag(p, reach).over(w))
                for m, p in levels[reach].items()
            }
        )
        reach *= 2
        levels[reach] = level
        made += level.values()
    out = {}
    for k in sizes:
        p = max(r for r in levels if r <= k)
        for m, name in levels[p].items():
            earlier = F.lag(name, k - p).over(w) if k > p else F.col(name)
            out[f"_{m}of_{k}"] = pick[m](F.col(name), earlier)
    return near.withColumns(out), [*made, *out]


def moving_average(
    ordered: DataFrame,
    columns: Sequence[str],
    rows: int = 50,
    keys: Sequence[str] = UNIT,
    suffix: str = "_sma",
    **blocks,
) -> DataFrame:
    """Mean of the last ``rows`` rows, from the first row on; NaN, infinite and missing readings are skipped."""
    near, w = frames(ordered, rows - 1, keys=keys, **_row_blocks([rows], blocks))
    near = near.repartition(task_count(ordered.sparkSession, ordered.count()), *keys, "_block")
    near, made, triples = _moving_moments(near, w, keys, columns, [rows])
    return own_rows(
        near.withColumns({f"{c}{suffix}": _forms(*triples[(c, rows)])["mean"] for c in columns})
    ).drop(*made)


def row_statistics(
    ordered: DataFrame,
    column: str,
    sizes: Sequence[int] = (12, 72, 288),
    statistics: Sequence[str] = ("mean", "std", "min", "max"),
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Mean, deviation, minimum and maximum over the last 12/72/288 rows.

    The work per row does not grow with the number of rows in the frame (mean, deviation) or
    grows with its logarithm (extremes).  NaN and infinite readings are missing.
    """
    near, w = frames(ordered, max(sizes) - 1, keys=keys, **_row_blocks(sizes, blocks))
    near = near.repartition(task_count(ordered.sparkSession, ordered.count()), *keys, "_block")
    made: list[str] = []
    triples = {}
    if {"mean", "std"} & set(statistics):
        near, names, triples = _moving_moments(near, w, keys, [column], sizes)
        made += names
    kinds = [m for m in ("min", "max") if m in statistics]
    if kinds:
        near, names = _moving_extremes(near, w, column, sizes, kinds)
        made += names
    out = {}
    for k in sizes:
        forms = _forms(*triples[(column, k)]) if triples else {}
        forms.update({"min": F.col(f"_minof_{k}"), "max": F.col(f"_maxof_{k}")})
        for s in statistics:
            out[f"{column}_roll_{s}_{k}"] = forms[s]
    return own_rows(near.withColumns(out)).drop(*made)


def edges(
    ordered: DataFrame, condition: Column, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Mark rows where ``condition`` turns true (``rising``) or stops being true (``falling``)."""
    near, w = frames(ordered.withColumn("_on", F.coalesce(condition, F.lit(False))), 1, keys=keys, **blocks)
    was = F.coalesce(F.lag("_on").over(w), F.lit(False))
    return own_rows(
        near.withColumns({"rising": F.col("_on") & ~was, "falling": ~F.col("_on") & was})
    ).drop("_on")


def increments(
    ordered: DataFrame, column: str, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Rows whose reading is larger than that of the row before."""
    near, w = frames(ordered, 1, keys=keys, **blocks)
    return own_rows(near.withColumn("increment", F.col(column) - F.lag(column).over(w))).filter(
        F.col("increment") > 0
    )


def seconds_since_start(df: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    starts = df.groupBy(*keys).agg(F.min("us").alias("_from"))
    return (
        attach(df, starts, keys)
        .withColumn("time_numeric", (F.col("us") - F.col("_from")) / F.lit(float(SECOND)))
        .drop("_from")
    )


def first_and_last(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = UNIT) -> DataFrame:
    """Reading of the first and of the last row of each group; no sort, no window."""
    place = F.struct("us", "seq")
    return df.groupBy(*keys).agg(
        *[F.min_by(c, place).alias(f"{c}_first") for c in columns],
        *[F.max_by(c, place).alias(f"{c}_last") for c in columns],
    )
