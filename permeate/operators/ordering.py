"""Ordered work on long series without ever putting one series into one task.

A unit may own a third of all rows, so ``Window.partitionBy('unit_id')`` is never used on
log rows.  Three building blocks replace it:

* :func:`row_index` numbers the rows of every series.  Rows are range-partitioned on
  (keys, order), which cuts a long series into as many pieces as its size needs; a row's
  number is its place in its piece plus the lengths of the pieces before it.
* :func:`frames` cuts each series into blocks of equally many rows and copies the few rows a
  ROWS frame reaches back (or ahead) for, so ``lag`` and moving windows are exact.
* :func:`running` gives running sums and carried values: a window inside each block plus the
  totals of all earlier blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from permeate.storage import attach, stage

UNIT = ("unit_id",)
ORDER = ("us", "seq")
BLOCK_ROWS = 32_768
#: About so many wide rows are handed to one task of a step that sorts them several times.
TASK_ROWS = 65_536


def task_count(spark: SparkSession, rows: int, per_task: int = TASK_ROWS) -> int:
    """Number of tasks for ``rows`` rows, so that the memory of one does not grow with the log.

    A number that is asked for is kept by adaptive execution.  Where the rows are few, there are
    as many tasks as the session's shuffles have, of 4,096 rows at least.
    """
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // per_task), min(usual, -(-rows // 4_096)))


def ordered_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ordered", tasks: int | None = None
) -> DataFrame:
    """Rows sorted on (keys, order) and cut into pieces of similar size, written once.

    ``_piece`` numbers the pieces in order, ``_place`` the rows; together with :func:`running`
    this is enough for anything that is carried along the order.  ``tasks`` asks for so many pieces.
    """
    place = [*keys, *order]
    return stage(
        (df.repartitionByRange(tasks, *place) if tasks else df.repartitionByRange(*place))
        .sortWithinPartitions(*place)
        .withColumn("_place", F.monotonically_increasing_id()),
        name,
    ).withColumn("_piece", F.shiftright("_place", 33))


def row_index(
    df: DataFrame,
    keys: Sequence[str] = UNIT,
    order: Sequence[str] = ORDER,
    index: str = "rn",
    name: str = "ordered",
) -> DataFrame:
    """Add ``index``, the 0-based position of each row inside its series.

    The sorted pieces are written once, because the two passes (piece lengths, then numbers)
    must see the same cut.  The table of lengths has one row per piece and key.
    """
    keys = list(keys)
    pieces = ordered_pieces(df, keys, order, name)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*keys, "_piece")
        .agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
        .select(*keys, "_piece", "_shift")
    )
    return (
        attach(pieces, starts, [*keys, "_piece"])
        .withColumn(index, F.col("_place") + F.col("_shift"))
        .drop("_piece", "_place", "_shift")
    )


def block_of(index: str, block_rows: int) -> Column:
    return F.floor(F.col(index) / F.lit(block_rows)).cast("long")


def frames(
    df: DataFrame,
    back: int,
    ahead: int = 0,
    keys: Sequence[str] = UNIT,
    index: str = "rn",
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, WindowSpec]:
    """Rows copied into every block whose frames can reach them, and the window over a block.

    Finish with :func:`own_rows` once the window columns are added.
    """
    block_rows = max(block_rows, back, ahead)
    rn = F.col(index)
    home = block_of(index, block_rows)
    near = df.withColumn("_home", home).withColumn(
        "_block",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(rn % block_rows < ahead, home - 1),
                    home,
                    F.when(rn % block_rows >= block_rows - back, home + 1),
                )
            )
        ),
    )
    return near, Window.partitionBy(*keys, "_block").orderBy(index)


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the copies made by :func:`frames`."""
    return df.filter(F.col("_block") == F.col("_home")).drop("_block", "_home")


def _held(kind: DataType) -> str:
    """Type a running value is held in: decimals keep their scale, with room for long sums."""
    return f"decimal(36,{kind.scale})" if isinstance(kind, DecimalType) else kind.simpleString()


def _local(kind: str, value: Column) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "max":
        return F.max(value)
    if kind == "min":
        return F.min(value)
    if kind == "last":
        return F.last(value, ignorenulls=True)
    raise ValueError(f"unknown running aggregate: {kind}")


def _merge(kind: str, earlier: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(earlier + here, earlier, here)
    if kind == "max":
        return F.greatest(earlier, here)
    if kind == "min":
        return F.least(earlier, here)
    return F.coalesce(here, earlier)


def running(
    df: DataFrame,
    aggregates: dict[str, tuple[str, str | Column]],
    keys: Sequence[str] = UNIT,
    index: str = "rn",
    reverse: bool = False,
    inclusive: bool = True,
    block_rows: int = BLOCK_ROWS,
    levels: int = 2,
    pieces: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Running ``sum``/``max``/``min``/``last`` (last = latest non-NULL) along each series.

    ``aggregates`` maps the new column to (kind, column or expression).  ``reverse`` runs from the
    end of the series; ``inclusive=False`` leaves the current row out.  ``df`` is read twice, so it
    should be a stored table with cheap expressions on top.  The block totals are themselves
    scanned in blocks, so after ``levels`` steps a window sees one row per
    ``block_rows ** levels`` log rows.  ``pieces=True`` takes the cut of :func:`ordered_pieces`
    instead of an index; then a window over the totals sees one row per piece.  ``tasks`` asks for
    so many tasks, where rows are wide.
    """
    keys = list(keys)
    if pieces:
        index, levels = "_place", 1
    frame_end = 0 if inclusive else -1
    direction = F.desc(index) if reverse else F.asc(index)
    values = {out: F.col(v) if isinstance(v, str) else v for out, (_, v) in aggregates.items()}
    typed = df.select(*[v.alias(out) for out, v in values.items()]).schema
    held = {out: _held(typed[out].dataType) for out in aggregates}

    def over(window: WindowSpec) -> dict[str, Column]:
        frame = window.orderBy(direction).rowsBetween(Window.unboundedPreceding, frame_end)
        return {
            out: _local(kind, F.col(f"_value_{out}")).over(frame).cast(held[out])
            for out, (kind, _) in aggregates.items()
        }

    sources = {f"_value_{out}": v for out, v in values.items()}
    if levels == 0:
        return df.withColumns(sources).withColumns(over(Window.partitionBy(*keys))).drop(*sources)
    blocked = df.withColumn("_block", F.col("_piece") if pieces else block_of(index, block_rows))
    # Rows are moved and sorted before the values are worked out, so only the columns of the
    # table travel; the window below finds its rows in place.
    local = (
        (blocked.repartition(tasks, *keys, "_block") if tasks else blocked.repartition(*keys, "_block"))
        .sortWithinPartitions(*keys, "_block", direction)
        .withColumns(sources)
        .withColumns(over(Window.partitionBy(*keys, "_block")))
        .drop(*sources)
    )
    totals = blocked.groupBy(*keys, "_block").agg(
        *[
            (
                (F.min_by if reverse else F.max_by)(values[out], F.when(values[out].isNotNull(), F.col(index)))
                if kind == "last"
                else _local(kind, values[out])
            )
            .cast(held[out])
            .alias(f"_carry_{out}")
            for out, (kind, _) in aggregates.items()
        ]
    )
    carried = running(
        totals.withColumnRenamed("_block", "_carry_block"),
        {f"_before_{out}": (kind, f"_carry_{out}") for out, (kind, _) in aggregates.items()},
        keys=keys,
        index="_carry_block",
        reverse=reverse,
        inclusive=False,
        block_rows=block_rows,
        levels=levels - 1,
    ).select(
        *keys,
        F.col("_carry_block").alias("_block"),
        *[f"_before_{out}" for out in aggregates],
    )
    return (
        local.join(carried, [*keys, "_block"])
        .withColumns(
            {
                out: _merge(kind, F.col(f"_before_{out}"), F.col(out)).cast(held[out])
                for out, (kind, _) in aggregates.items()
            }
        )
        .drop("_block", *[f"_before_{out}" for out in aggregates])
    )


def series_length(df: DataFrame, keys: Sequence[str] = UNIT, name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))
