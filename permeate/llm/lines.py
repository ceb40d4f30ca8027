"""Fuzzy line dedup by MinHash, with DataFrame functions only.

A line's set holds its overlapping pieces of ``SIZE`` characters (a shorter line is one piece),
after lower-casing and trimming. Lines are similar from a Jaccard similarity of 0.8 on.

1. Equal lines are one, known by a 64-bit hash; each is signed once.
2. A signature holds ``MINIMA`` least hashes of all pieces, each under an order of its own, ``ROWS`` to a
   band. Lines that agree in a band meet: about 997 of 1,000 pairs of similarity 0.8 do.
3. Of a line that meets another, the size of its set and a bit for the parity of the pieces that fall
   on each of ``BITS`` places are kept. Sets that differ in d pieces differ in d places at most, so pairs that
   differ in too many are ruled out; the others are verified on their full sets. A line is first held against one
   hub, the nearest by these places of a few of each of its bands; what is still apart after contraction is paired in full. So groups
   of copies do not become all their pairs.
4. Components by distributed union-find; of each, the first line by (doc_id, place) stays.

Defined cases: blank lines all stay; a null text stays null and has no lines; an empty text has no
lines that count; a document without an id stays as it is and takes no part; rows of one id count as
one document, so a line stays at its first place in each of them; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.graph import components, linked
from permeate.llm.tables import BROADCAST_ROWS, pick, stored

SIZE = 8
SHARE, SHARE_OF = 80, 100
BANDS, ROWS = 8, 3
MINIMA = BANDS * ROWS
LANES = 8
BITS = 64 * LANES

#: The orders of a band look at a hash turned by 0, 21 and 42 bits, each from a bin of its own (the first three bits).
TURN, _REST = 21, 61
_TOPS = [[((2 * r + 1) * b + 3 * r) % BANDS for r in range(ROWS)] for b in range(BANDS)]
_ORDERS = [[(t << _REST) - (1 << 64 if t > 3 else 0) for t in tops] for tops in _TOPS]
#: A line of more pieces than twice ``FULL`` passes on those at the front of their bins (three a bin or more
#: are expected) and its first ``LEAD``: others are no minima, but where a bin is left empty.
FULL, LEAD = 24, 64

_BLANKS = " \t\r\x0b\x0c"
_KEYS = [f"b{b}" for b in range(BANDS)]
_PARITIES = [f"p{i}" for i in range(LANES)]


def _bare(line: Column) -> Column:
    ahead = F.ltrim(line, F.lit(_BLANKS))
    # To cut at the end, the places of all characters are listed first, so only lines that need it are cut.
    return F.when(reduce(Column.__or__, [F.endswith(ahead, F.lit(c)) for c in _BLANKS]), F.rtrim(ahead, F.lit(_BLANKS))).otherwise(ahead)


def _norm(line: Column) -> Column:
    return F.lower(_bare(line))


def _hashes(norm: Column) -> Column:
    """A hash of the piece at each place; pieces are cut from four bytes a character, where a place is found at once."""

    def cut(b: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.octet_length(b) - (4 * SIZE - 1), F.lit(1)), F.lit(4))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(b, i, F.lit(4 * SIZE))))

    # Bound to a name by a function, the bytes are made once per line.
    return F.transform(F.array(F.encode(norm, "UTF-32")), cut)[0]


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, place and text of every line."""
    plain = pick(docs, "doc_id", "text").where("doc_id is not null")
    return plain.select(F.col("doc_id").cast("long"), F.posexplode(F.split("text", "\n")).alias("place", "raw"))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, place, norm of every line that is not blank."""
    return _lines(docs).select("doc_id", "place", _norm(F.col("raw")).alias("norm")).where("norm <> ''")


def hashed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, place, line (its hash), norm of every line that is not blank."""
    return lines_of(docs).select("doc_id", "place", F.xxhash64("norm").alias("line"), "norm")


def _pieces(lines: DataFrame) -> DataFrame:
    """doc_id, place, line and the hash, turned (h0, h1, ...), of each piece that may be least under an order."""
    size = F.octet_length("bytes")
    plain = lines.select("doc_id", "place", "line", F.encode("norm", "UTF-32").alias("bytes"))
    halved = F.greatest(F.floor(F.log2(size / F.lit(4 * FULL))), F.lit(0)).cast("int")
    front = F.call_function("shiftright", F.lit((1 << _REST) - 1), halved)
    starts = F.sequence(F.lit(1), F.greatest(size - (4 * SIZE - 1), F.lit(1)), F.lit(4))
    every = plain.select("doc_id", "place", "line", "bytes", front.alias("front"), F.explode(starts).alias("at"))
    hash_0 = F.xxhash64(F.substring(F.col("bytes"), F.col("at"), F.lit(4 * SIZE)))
    # The filter below reads the hash several times and would make it anew each time; it is not moved before a
    # column that Spark holds for not deterministic, as that of the partition (of which no bit is taken).
    none = F.spark_partition_id().cast("long").bitwiseAND(F.lit(0).cast("long"))
    hashed = every.select("doc_id", "place", "line", "front", "at", hash_0.bitwiseXOR(none).alias("h0"))
    turned = [F.col("h0")]
    for r in range(1, ROWS):
        turned.append(F.shiftleft("h0", r * TURN).bitwiseOR(F.shiftrightunsigned("h0", 64 - r * TURN)))
    ahead = [h.bitwiseAND(F.lit((1 << _REST) - 1)) <= F.col("front") for h in turned]
    kept = reduce(Column.__or__, ahead, F.col("at") <= 4 * LEAD)
    return hashed.where(kept).select("doc_id", "place", "line", *[h.alias(f"h{r}") for r, h in enumerate(turned)])


def _signed(lines: DataFrame) -> DataFrame:
    """line (its hash), doc_id, place (where it is first) and the band keys b0, b1, ... of each different line.

    Orders differ by an exclusive or of the hashes, so pieces are hashed once. The lines are dealt by
    their hashes when equal ones become one, and stay where they are when their pieces are put together.
    """
    at = F.min(F.struct("doc_id", "place")).alias("at")
    once = lines.withColumn("line", F.xxhash64("norm")).groupBy("line").agg(at, F.min("norm").alias("norm"))
    least = [F.min(F.col(f"h{r}").bitwiseXOR(F.lit(_ORDERS[b][r]))).alias(f"m{b + r * BANDS}") for r in range(ROWS) for b in range(BANDS)]
    minima = _pieces(once.select("line", "at.*", "norm")).groupBy("line", "doc_id", "place").agg(*least)
    bands = [F.xxhash64(F.lit(b), *[F.col(f"m{b + r * BANDS}") for r in range(ROWS)]).alias(f"b{b}") for b in range(BANDS)]
    return minima.select("line", "doc_id", "place", *bands)


def _sets(texts: DataFrame) -> DataFrame:
    """node (the line), n (the size of its set), p0, p1, ... (the parities of its pieces' places) and most (how many
    places may differ from those of a similar line).

    Sets of similarity 0.8 differ in a quarter of the smaller one's pieces at most. Where these are many
    for the places, several fall on one, so fewer places differ: four standard deviations over the mean may.
    """
    # Functions of a lambda are not compiled, so they have a step of their own.
    pieces = texts.select("line", F.array_distinct(_hashes(F.col("norm"))).alias("set")).select("line", F.explode("set").alias("h"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    lane = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(LANES - 1))
    parities = [F.bit_xor(F.when(lane == i, bit).otherwise(F.lit(0).cast("long"))).alias(p) for i, p in enumerate(_PARITIES)]
    sets = pieces.groupBy("line").agg(F.count("*").alias("n"), *parities)
    differ = F.col("n") * (SHARE_OF - SHARE) / SHARE
    mean = BITS / 2 * (1 - F.exp(-2 * differ / BITS))
    most = F.ceil(mean + 4 * F.sqrt(BITS / 4 * (1 - F.exp(-4 * differ / BITS))))
    return sets.select(F.col("line").alias("node"), "n", *_PARITIES, most.alias("most"))


def _places(x: str, y: str) -> Column:
    """In how many places the parities of two lines differ."""
    return reduce(Column.__add__, [F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in _PARITIES])


def _could(x: str, y: str) -> Column:
    """Whether the sets of two lines are of such sizes, and differ in so few places, that they may be similar."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    # Of similar sets, all that differs is at most this share of both sizes.
    share = (n + m) * (SHARE_OF - SHARE) / (SHARE_OF + SHARE)
    return (F.least(n, m) * SHARE_OF >= F.greatest(n, m) * SHARE) & (_places(x, y) <= F.least(share, f"{x}.most", f"{y}.most"))


def _near(x: str, y: str) -> Column:
    return _places(x, y) / (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def similar(lines: DataFrame, signed: DataFrame) -> DataFrame:
    """Links (a, b) between different similar lines that connect all that are similar."""
    keyed = signed.select(F.col("line").alias("node"), F.explode(F.array(*_KEYS)).alias("key"))
    met = keyed.groupBy("key").count().where("count > 1").select("key")
    held = stored(keyed.join(_few(stored(met, "lines-met")), "key"), "lines-held")
    wanted = stored(held.select(F.col("node").alias("line")).distinct(), "lines-wanted")
    found = lines.select("line", "norm").join(_few(wanted), "line")
    texts = stored(found.groupBy("line").agg(F.min("norm").alias("norm")), "lines-texts")
    sets = stored(_sets(texts), "lines-sets")
    meeting = stored(held.join(sets, "node"), "lines-meeting")
    sized = stored(texts.join(sets.select(F.col("node").alias("line"), "n"), "line"), "lines-sized")

    def verify(pairs: DataFrame) -> DataFrame:
        left = sized.select(F.col("line").alias("a"), F.col("norm").alias("norm_a"), F.col("n").alias("n_a"))
        right = sized.select(F.col("line").alias("b"), F.col("norm").alias("norm_b"), F.col("n").alias("n_b"))
        both = F.size(F.array_intersect(_hashes(F.col("norm_a")), _hashes(F.col("norm_b"))))
        # Both sizes are known, so the pieces of either are those sizes less what is in both.
        return pairs.join(left, "a").join(right, "b").where(both * (SHARE_OF + SHARE) >= (F.col("n_a") + F.col("n_b")) * SHARE).select("a", "b")

    return linked(meeting, verify, _could, near=_near, small="n", met=True)


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, places: the lines of each document that go."""
    lines = stored(hashed_lines(docs), "lines-hashed")
    signed = stored(_signed(lines), "lines-signed")
    labels = stored(components(similar(lines, signed)), "lines-labels").withColumnRenamed("node", "line")
    all_lines = lines.select("doc_id", "place", "line").join(_few(labels), "line", "left")
    placed = stored(all_lines.select("doc_id", "place", F.coalesce("component", "line").alias("label")), "lines-placed")
    counts = placed.groupBy("label").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1")
    first_doc = stored(counts.select("label", F.col("doc_id").alias("first_doc")), "lines-first")
    held = placed.join(_few(first_doc), "label")
    place = held.where("doc_id = first_doc").groupBy("label").agg(F.min("place").alias("first_place"))
    gone = held.join(_few(stored(place, "lines-place")), "label").where("doc_id <> first_doc or place <> first_place")
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("place")).alias("places"))


def deduped(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_kept, text: every document without its repeated lines."""
    gone = _few(stored(repeated(docs), "lines-gone").withColumnRenamed("doc_id", "_id"))
    plain = pick(docs, "doc_id", "text")
    parted = plain.withColumn("lines", F.split("text", "\n"))
    joined = parted.join(gone, F.col("doc_id").cast("long") == F.col("_id"), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.when(F.col("places").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get(F.col("lines"), i)))

    def counted(lines: Column) -> Column:
        return F.coalesce(F.size(F.filter(lines, lambda x: _bare(x) != "")), F.lit(0)).cast("long")

    return joined.withColumn("kept", kept).select(
        "doc_id",
        counted(F.col("lines")).alias("n_lines"),
        counted(F.col("kept")).alias("n_kept"),
        F.array_join("kept", "\n").alias("text"),
    )
