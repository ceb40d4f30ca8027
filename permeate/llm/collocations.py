"""Phrase collocations: word runs of 2 to 4 words that occur together far more than their parts.

Texts are lower-cased (A-Z only; null is empty), cut at ``.,;:!?`` and controls 10 to 13 into
pieces, and pieces into words at blanks and tabs.  Everything is counted per language (null:
``und``): ``n`` is the number of word occurrences, ``f(phrase)`` the number of its contiguous
occurrences inside pieces, overlaps included.

Counting by top-order marginalisation: every word occurrence opens one lead window of the
``ORDER`` words from it on, cut where its piece ends, and only these windows are counted, instead of
one explosion per n-gram length.  An n-gram occurs once for each window that begins with it, so the
counts of windows sum up to those of their prefixes.  A phrase is no more frequent than the word
pairs in it: pairs are counted first (their counts are those of the phrases of two words), a
window stops before a word that follows its predecessor fewer than ``LEAST`` times, and only
windows of three words or more are shuffled.  Words are known by a 64-bit hash that also tells the
language; frequent ones also by a dense number, and two numbers travel as one.

Candidates are phrases of 2 to ``ORDER`` words with ``a = f >= LEAST``.  A candidate's cut after
its first k words scores ``floor(2000000 * a / (l + r))`` with l, r the counts of both parts; the
lowest score counts, ties to the smallest k (exact integers: the product is taken in 38 digits).
A candidate inside a longer candidate (dropped or not) that holds ``100 * f(longer) >= 80 * a``
is dropped.  Each language's first ``TOP`` by score, then a, descending, then phrase in UTF-8
byte order are returned.  An empty table gives no rows; repeated rows count again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from permeate.llm.tables import BROADCAST_ROWS, numbered, pick, stored

ORDER = 4
LEAST = 30
TOP = 2000
#: Ranks are first taken within so many buckets of a language's phrases, then across them.
BUCKETS = 64
_PIECES = r"[.,;:!?\x0A-\x0D]"
_WORDS = r"[\x20\x09]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(docs: DataFrame) -> DataFrame:
    """lang, ws: the words of each piece of each text."""
    plain = pick(docs, "text", "lang").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER).alias("t"),
    )
    pieces = plain.select("lang", F.explode(F.split("t", _PIECES)).alias("piece"))
    bare = pieces.select("lang", F.trim("piece", F.lit(" \t")).alias("piece")).where("piece <> ''")
    return bare.select("lang", F.split("piece", _WORDS).alias("ws"))


def _hashed(lang: Column, word: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), lang, word)


def vocabulary_of(pieces: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """(lang, n), the words of at least ``least`` occurrences with their name ``id``, number ``no``
    and count ``f``, and the salt of the names.

    A word's name is a 64-bit hash of (salt, lang, word); the salt grows until no two distinct
    words of the whole table share a name, so names are exact.  Numbers are gapless from 0.
    """
    words = stored(
        pieces.select("lang", F.explode("ws").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("f")),
        "collocation-words",
    )
    salt = 0
    while words.groupBy(_hashed(F.col("lang"), F.col("word"), salt)).count().where("count > 1").limit(1).count():
        salt += 1
    n = words.groupBy("lang").agg(F.sum("f").cast("long").alias("n"))
    frequent = words.where(F.col("f") >= least).select(
        "lang", "word", _hashed(F.col("lang"), F.col("word"), salt).alias("id"), F.col("f").cast("long").alias("f")
    )
    placed = numbered(frequent, [F.col("id")], "collocation-frequent", "no")
    return n, stored(placed, "collocation-vocabulary"), salt


def _numbers(pieces: DataFrame, salt: int) -> DataFrame:
    """The word names of every piece of two words or more."""
    return pieces.where(F.size("ws") >= 2).select(F.transform("ws", lambda w: _hashed(F.col("lang"), w, salt)).alias("hs"))


def _runs(pieces: DataFrame, salt: int, names: list[str]) -> DataFrame:
    """A row per word of each piece that another follows: its name and those of the words after
    it, one per name, NULL where the piece ends."""
    ahead = [F.col("hs")] + [F.slice("hs", F.lit(k + 1), F.size("hs")) for k in range(1, len(names))]
    return _numbers(pieces, salt).select(F.inline(F.arrays_zip(*ahead)).alias(*names)).where(F.col(names[1]).isNotNull())


def _packed(numbers: list[Column], size: int) -> list[Column]:
    """Word numbers below ``size``, NULL where a window ends, two to a long."""
    one_up = [F.coalesce(x + 1, F.lit(0)) for x in numbers]
    two = [x * F.lit(size + 1) + y for x, y in zip(one_up[::2], one_up[1::2], strict=False)]
    return two + one_up[len(two) * 2 :]


def _unpacked(packed: list[Column], count: int, size: int) -> list[Column]:
    out = []
    for x in packed:
        pair = [F.call_function("div", x, F.lit(size + 1)), x % F.lit(size + 1)] if count - len(out) > 1 else [x]
        out += [F.when(y > 0, y - 1) for y in pair]
    return out


def frequent_pairs(pieces: DataFrame, vocabulary: DataFrame, salt: int, least: int) -> DataFrame:
    """(a, b, a_no, b_no, f): names, numbers and count of adjacent words that follow each other at
    least ``least`` times.

    A pair is no more frequent than its words, so pairs with a word outside ``vocabulary`` are left
    out and the others shuffled as one number each, where the vocabulary is small enough to be at hand.
    """
    pairs, size = _runs(pieces, salt, ["a", "b"]), vocabulary.count()
    at_hand = size <= BROADCAST_ROWS

    def known(df: DataFrame, by: str) -> DataFrame:
        for side in ("a", "b"):
            names = vocabulary.select(F.col("id").alias(side), F.col("no").alias(f"{side}_no"))
            df = df.join(F.broadcast(names) if at_hand else names, side + by)
        return df

    if at_hand:
        both = _packed([F.col("a_no"), F.col("b_no")], size)[0]
        counted = known(pairs, "").groupBy(both.alias("both")).agg(F.count("*").alias("f")).where(F.col("f") >= least)
        a_no, b_no = _unpacked([F.col("both")], 2, size)
        named = known(counted.select(a_no.alias("a_no"), b_no.alias("b_no"), "f"), "_no")
    else:
        named = known(pairs.groupBy("a", "b").agg(F.count("*").alias("f")).where(F.col("f") >= least), "")
    return stored(named.select("a", "b", "a_no", "b_no", F.col("f").cast("long").alias("f")), "collocation-pairs")


def windows(pieces: DataFrame, pairs: DataFrame, salt: int, size: int, order: int = ORDER) -> DataFrame:
    """Lead windows of three words or more, n1 .. n_order (word numbers, NULL from the end on), with
    their count c.

    A window ends before the first word that does not follow its predecessor in ``pairs``: no longer
    phrase holding that pair can be frequent.  A window of fewer than three words adds only to
    counts that words and pairs already hold, and is left out.  Windows are made inside each piece's
    array, so no row carries its piece along.
    """
    names, numbers = ([f"{x}{k}" for k in range(1, order + 1)] for x in "wn")
    opened = _runs(pieces, salt, names)
    rows = pairs.count()
    for k in range(order - 1):
        first = [F.col("a_no").alias(numbers[0])] if not k else []
        side = pairs.select(F.col("a").alias(names[k]), F.col("b").alias(names[k + 1]), *first, F.col("b_no").alias(numbers[k + 1]))
        side = F.broadcast(side) if rows <= BROADCAST_ROWS else side
        opened = opened.join(side, names[k : k + 2], "inner" if k < 2 else "left")
    ids, going = [], F.lit(True)
    for c in numbers:
        going = going & F.col(c).isNotNull()
        ids.append(F.when(going, F.col(c)))
    packed = [x.alias(f"p{i}") for i, x in enumerate(_packed(ids, size))]
    keys = [f"p{i}" for i in range(len(packed))]
    counted = opened.select(*packed).groupBy(*keys).agg(F.count("*").alias("c"))
    plain = _unpacked([F.col(x) for x in keys], order, size)
    return counted.select(*[x.alias(c) for x, c in zip(plain, numbers, strict=True)], "c")


def counts(docs: DataFrame, order: int = ORDER, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, ws, f) of all phrases of up to ``order`` words with f >= ``least``, and (lang, n)."""
    pieces = stored(_words(docs), "collocation-pieces")
    n, vocabulary, salt = vocabulary_of(pieces, least)
    size = vocabulary.count()
    pairs = frequent_pairs(pieces, vocabulary, salt, least)

    def level(k: int, df: DataFrame, ids: list, f: Column | str) -> DataFrame:
        return df.select(F.lit(k).alias("k"), F.array(*ids).alias("ids"), F.col(f).cast("long").alias("f"))

    frequent = level(1, vocabulary, ["no"], "f").unionByName(level(2, pairs, ["a_no", "b_no"], "f"))
    if order > 2:
        counted = windows(pieces, pairs, salt, size, order)
        longer = []
        for k in range(3, order + 1):
            ids = [f"n{i}" for i in range(1, k + 1)]
            # Counts of windows that reach a k-th word; as counts, not as a filter on keys that would
            # count the windows anew for each k.
            held = counted.withColumn("c", F.when(F.col(ids[-1]).isNotNull(), F.col("c")))
            if k < order:
                packed = _packed([F.col(c) for c in ids], size)
                keys = [f"p{i}" for i in range(len(packed))]
                summed = held.groupBy(*[x.alias(c) for x, c in zip(packed, keys, strict=True)]).agg(F.sum("c").alias("c"))
                plain = _unpacked([F.col(c) for c in keys], k, size)
                held = summed.select(*[x.alias(c) for x, c in zip(plain, ids, strict=True)], "c")
            longer.append(level(k, held.where(F.col("c") >= least), ids, "c"))
        rolled = longer[0]
        for more in longer[1:]:
            rolled = rolled.unionByName(more)
        frequent = frequent.unionByName(stored(rolled, "collocation-longer"))
    # Back from numbers to words: one row per frequent phrase and word.
    spelled = (
        frequent.select("k", "ids", "f", F.posexplode("ids").alias("at", "no"))
        .join(vocabulary.select("no", "lang", "word"), "no")
        .groupBy("k", "ids", "f")
        .agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        .select("lang", "k", F.col("spelt.word").alias("ws"), "f")
    )
    return spelled.withColumn("phrase", F.array_join("ws", " ")), n


def collocations(docs: DataFrame, order: int = ORDER, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    frequent, n = counts(docs, order, least)
    frequent = stored(frequent, "collocation-counts")
    candidates = frequent.where("k >= 2").select("lang", "k", "ws", "phrase", F.col("f").alias("a"))
    parts = frequent.select("lang", "phrase", "f")
    cuts = candidates.select("lang", "k", "ws", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j"))
    cuts = cuts.withColumns(
        {
            "left": F.array_join(F.slice("ws", F.lit(1), F.col("j")), " "),
            "right": F.array_join(F.slice("ws", F.col("j") + 1, F.col("k") - F.col("j")), " "),
        }
    )
    scored = (
        cuts.join(parts.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"])
        .join(parts.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
        .withColumn("score", F.expr("cast((cast(a as decimal(38,0)) * 2000000) div (l + r) as long)"))
    )
    best = scored.groupBy("lang", "phrase", "k", "a").agg(
        F.min_by(F.struct("l", "r", "score"), F.struct("score", "j")).alias("cut")
    ).select("lang", "phrase", "k", "a", "cut.*")
    # Every run of 2 or more words inside a longer candidate, with the longer one's count.
    inner = candidates.where(F.col("k") >= 3).select(
        "lang",
        "a",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("k") - 1),
                    lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice("ws", i, m), " ")),
                )
            )
        ).alias("phrase"),
    )
    covering = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(covering, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 80)
    )
    order_by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    near_top = kept.withColumn("_b", bucket).withColumn(
        "_r", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order_by))
    ).where(F.col("_r") <= top)
    ranked = near_top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by))).where(
        F.col("rank") <= top
    )
    return ranked.join(n, "lang").select(
        "lang",
        F.col("rank").cast("long"),
        "phrase",
        F.col("a").cast("long"),
        F.col("l").cast("long"),
        F.col("r").cast("long"),
        F.col("n").cast("long"),
        F.col("score").cast("long"),
    )


_LOWERING = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

#: The same rows in SQL: every n-gram of every piece counted directly.
SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWERING}, '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
sized as (select lang, ws, len(ws) as m, unnest(range(1, {ORDER + 1})) as k from words where len(ws) > 0),
grams as (
  select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase
  from (select lang, ws, k, unnest(range(1, m - k + 2)) as i from sized where m >= k)),
freq as (select lang, k, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from freq where k = 1 group by lang),
cands as (select lang, k, phrase, f as a from freq where k >= 2 and f >= {LEAST}),
cuts as (
  select c.lang, c.phrase, c.k, c.a, j,
         array_to_string(string_split(c.phrase, ' ')[1 : j], ' ') as lp,
         array_to_string(string_split(c.phrase, ' ')[j + 1 : c.k], ' ') as rp
  from (select *, unnest(range(1, k)) as j from cands) c),
scored as (
  select cuts.*, fl.f as l, fr.f as r, ((a::hugeint * 2000000) // (fl.f + fr.f))::bigint as score
  from cuts join freq fl on fl.lang = cuts.lang and fl.phrase = lp
            join freq fr on fr.lang = cuts.lang and fr.phrase = rp),
best as (
  select * from (select *, row_number() over (partition by lang, phrase order by score, j) as o from scored) where o = 1),
kept as (
  select * from best b where not exists (
    select 1 from cands c where c.lang = b.lang and c.k > b.k and 100 * c.a >= 80 * b.a
      and contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
select lang, rank, phrase, a, l, r, n, score from (
  select kept.lang, row_number() over (partition by kept.lang order by score desc, a desc, phrase asc) as rank,
         phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score
  from kept join totals using (lang))
where rank <= {TOP}
"""
