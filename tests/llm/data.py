"""Small awkward tables that every operator must take."""

import random
import zlib

WORDS = "the of and river stone walks under green light over many small hands hold quiet water slowly".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "ed", "ing", str(draw.randrange(40))]) for _ in range(n))


def documents(spark, rows=None):
    """doc_id, text, lang, source, n_chars and columns whose names clash with results and internals."""
    if rows is None:
        rows = [(i, prose(i, 30 + i % 50), "en" if i % 3 else "fr", f"src{i % 4}") for i in range(40)]
        rows += [
            (100, None, "en", "src0"),
            (101, "", None, None),
            (102, " \n\t ", "fr", None),
            (103, "12 34 !! --", "en", "src1"),
            (104, rows[3][1], "en", "src0"),
            (104, rows[3][1], "en", "src0"),
            (None, rows[3][1], "en", "src2"),
            (105, prose(3, 33).replace("river", "RIVER"), "en", None),
            (106, prose(7, 9000), "en", "src3"),
            (107, "x" * 70000, "en", "src3"),
            (108, "été ñandú 文字 слово " * 12, "fr", "src1"),
        ]
    return spark.createDataFrame(
        [(i, t, g, s, len(t or ""), 1.5, "x", True) for i, t, g, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, Size string, label boolean",
    )


def empty(spark, columns="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([], columns)


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())
