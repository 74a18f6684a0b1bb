"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside, as further columns of the input.
CLASHING = ("key", "label", "row", "blob", "found", "part", "n", "rep", "root", "data", "seed", "at", "hash", "slots", "id", "ids", "digest",
            "size", "kept", "shard", "_id", "_key", "_gone", "rules", "runs", "bands", "sketch", "component")


def equal_polynomials(letters: int = 1024) -> tuple[str, str]:
    """Two strings of y and z, after Thue and Morse, that have equal polynomial hashes modulo 2**64 for any odd base and any table."""
    one = "".join("yz"[k.bit_count() % 2] for k in range(letters))
    return one, one.translate({121: 122, 122: 121})


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}{rng.choice(['', '', ',', '.'])}" for _ in range(words))


def awkward() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, copies, near copies, repeated rows, a long word, a long text, odd characters."""
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "other"
    passage = prose(2, 30)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, base), (5, base), (5, base), (6, " ".join(near)), (7, base.upper()), (8, "one two"), (9, "ONE two"),
            (10, "x" * 5000), (11, prose(3, 20000)), (12, prose(4, 40) + "\n" + passage + "\n" + prose(5, 40)),
            (13, prose(6, 40) + " " + passage + " " + prose(7, 40)), (14, "naïve 北京 😀 ▁mark joined\x1c" * 20), (15, "\r\n\r\n a\x0bb\x0cc "),
            (16, "same words again " * 200), (17, "line one\nline one\n\nline one\n line two "), (None, base), (None, None)]
    one, other = equal_polynomials()
    rows += [(20, prose(8, 12) + " " + one), (21, prose(8, 12) + " " + other), (22, one + "\n" + other + "\n" + one), (23, "a b " + one), (24, "a b " + other)]
    return [*rows, *((100 + i, prose(50 + i, 10 + 7 * i)) for i in range(20))]


def documents(spark: SparkSession, rows: list[tuple] | None = None, clashing: bool = True, parts: int = 3) -> DataFrame:
    rows = awkward() if rows is None else rows
    made = spark.createDataFrame([(i, t, ("en", "de", None)[k % 3], f"s{k % 2}", len(t or "") if k % 5 else None) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
    return made.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else made


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
