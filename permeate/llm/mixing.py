"""Mixing sources to target weights: repetition rates per source, copies per document.

A source's target is its share by weight of all tokens, never above ``most`` times its own size;
what a source cannot take goes to the others by weight. A document is emitted floor(rate) times,
plus once more if a draw seeded by its id falls below the fraction of the rate.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
documents of one id draw alike; an empty table gives an empty result; other columns of the input
are kept by ``mixed`` and ignored by ``plan``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import BROADCAST_ROWS, numbered, pick, stored

#: What counts as a token, and the weights that the sources take in turn.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> source, source_size, target. ``sizes`` has one row per source.

    The level R/W that the open sources share is raised until no further one would exceed its
    limit; each round is one aggregate of two numbers over the sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = numbered(sizes, order, "mix-sources", "_place")
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int"))
    held = stored(placed.withColumn("_weight", turn.cast("long")).drop("_place"), "mix-weights")
    whole = F.col("source_size").cast("decimal(38,0)")
    limit = whole * F.lit(most)
    everything = int(held.agg(F.sum(whole)).first()[0] or 0)
    closed: Column = F.lit(False)
    n_closed, share, weight = -1, everything, 0
    while True:
        row = held.agg(
            F.count_if(closed),
            F.sum(F.when(closed, limit)),
            F.sum(F.when(~closed, F.col("_weight"))),
        ).first()
        share, weight = everything - int(row[1] or 0), int(row[2] or 0)
        if row[0] == n_closed or not weight:
            break
        n_closed = row[0]
        scaled = F.col("_weight").cast("decimal(18,0)") * F.lit(Decimal(share))
        closed = closed | (limit * F.lit(Decimal(weight)) < scaled)
    level = F.col("_weight").cast("double") * F.lit(float(share)) / F.lit(float(weight or 1))
    return held.select(
        "source",
        "source_size",
        F.when(closed, (F.col("source_size") * most).cast("double")).otherwise(level).alias("target"),
    )


def _draw(doc_id: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def copies(doc_id: Column, source_size: Column, target: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(0.0)
    whole = F.floor(rate)
    return (whole + (_draw(doc_id) < rate - whole).cast("long")).cast("int")


def _rates(sized: DataFrame) -> DataFrame:
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return source_targets(stored(by_source, "mix-sizes"))


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, copies: what the mix does with each document."""
    sized = stored(
        pick(docs, "doc_id", "source", "text").select("doc_id", "source", words_in(F.col("text")).alias("size")),
        "mix-docs",
    )
    rates = _with_rates(sized, _rates(sized), "source", F.col("doc_id"))
    return rates.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies(F.col("doc_id"), F.col("source_size"), F.col("target")).alias("copies"),
    )


def _with_rates(df: DataFrame, rates: DataFrame, source: str, doc_id: Column) -> DataFrame:
    """Each row with its source's size and target.

    Few sources are broadcast (their rows are counted); beyond that both sides are dealt by the
    source and a salt, so that a hot source is cut in many.
    """
    salts = 64
    renamed = stored(rates.withColumnRenamed("source", "_source"), "mix-targets")
    if renamed.count() <= BROADCAST_ROWS:
        match = F.col(source).eqNullSafe(F.col("_source"))
        return df.join(F.broadcast(renamed), match, "left").drop("_source")
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))
    left = df.withColumn("_key", key).withColumn(
        "_salt", F.pmod(F.xxhash64(doc_id), F.lit(salts)).cast("int")
    )
    right = (
        renamed.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit("null")))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .drop("_source")
    )
    return left.join(right, ["_key", "_salt"], "left").drop("_key", "_salt")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents as the mix repeats them, with all their columns."""
    columns = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(columns))])
    at = {name: F.col(f"_{columns.index(name)}") for name in ("doc_id", "source", "text")}
    sized = plain.select(at["source"].alias("source"), words_in(at["text"]).alias("size"))
    rated = _with_rates(plain, _rates(sized), f"_{columns.index('source')}", at["doc_id"])
    times = copies(at["doc_id"], F.col("source_size"), F.col("target"))
    repeated = rated.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.select([F.col(f"_{i}").alias(name) for i, name in enumerate(columns)])


def documents_mixed(docs: DataFrame) -> DataFrame:
    """The query's rows: words taken of each document."""
    return plan(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


#: The same rows in SQL: the level at which the k sources of least limit per weight are closed.
SQL = r"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sources as (
  select source, sum(size)::hugeint as source_size,
    1 + (row_number() over (order by source is null, encode(source)) - 1) % 3 as weight
  from sized group by source),
lined as (
  select *, row_number() over (order by source_size::double / weight, weight, source is null, encode(source)) as k
  from sources),
levels as (
  select *,
    (select sum(source_size) from sources) - coalesce(sum(3 * source_size) over before, 0) as share,
    (select sum(weight) from sources) - coalesce(sum(weight) over before, 0) as open_weight
  from lined
  window before as (order by k rows between unbounded preceding and 1 preceding)),
level as (
  select share, open_weight from levels
  where 3 * source_size * open_weight >= weight * share order by k limit 1),
targets as (
  select source, source_size,
    case when 3 * source_size * open_weight < weight * share then (3 * source_size)::double
      else weight::double * share::double / open_weight::double end as target
  from sources, level),
rated as (
  select doc_id, size, source_size, target,
    case when source_size > 0 then target / source_size::double else 0 end as rate
  from sized join targets on sized.source is not distinct from targets.source)
select doc_id, size, source_size::bigint as source_size, target,
  size * (floor(rate)::bigint + case when
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 12))::bigint::double
      / 281474976710656.0 < rate - floor(rate) then 1 else 0 end) as taken
from rated
"""
