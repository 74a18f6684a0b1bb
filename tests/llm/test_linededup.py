import random
import re

import numpy as np
import pyarrow as pa
import pytest
from ddlscope.llm import linededup, queries
from tests.compare import difference
from tests.conftest import SMALL
from tests.llm.tables import awkward, documents, empty

ENDS = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")


def key(line):
    return ENDS.sub("", line).translate({c: c + 32 for c in range(65, 91)})


def brute(rows, chars, least):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [i is not None and len(key(x)) >= chars and len(holders[key(x)]) >= least and i < max(holders[key(x)]) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def found(rows, **more):
    return sorted((tuple(r) for r in linededup.without_repeated_lines(rows, **more).collect()), key=str)


def lined(seed, texts=120, vocabulary=30):
    rng = random.Random(seed)
    some = [f"line number {k} of a few é{'x' * (k % 9)}" for k in range(vocabulary)]
    pad = ["", " ", "\t", "\r", "\x0b"]
    return [(rng.randrange(60), "\n".join(rng.choice(pad) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(pad)
             for x in rng.choices(some, k=rng.randrange(12)))) for _ in range(texts)]


@pytest.mark.parametrize("least", [2, 3, 4])
def test_equals_brute_force(spark, least):
    rows = awkward() + lined(1) + [(5, "a common line of some length")] * 40 + [(-3, "A COMMON LINE of some length ")] + [
        (700 + i, f"a common line of some length\nown {i} line that nobody else has\n\n a common line of some length") for i in range(300)]
    assert found(documents(spark, rows), least_documents=least, least_chars=20) == brute(rows, 20, least)


def test_code_points_count_and_not_bytes(spark):
    rows = [(i, "é" * 19 + "\n" + "é" * 20 + "\n  " + "x" * 19 + "\t\n" + "X" * 20) for i in range(4)]
    assert found(documents(spark, rows)) == brute(rows, 20, 3)
    assert [r[2] for r in found(documents(spark, rows))] == [2, 2, 2, 0]


def test_no_rows_and_no_repeats(spark):
    assert found(empty(spark)) == []
    assert found(documents(spark, [(1, None), (None, "x" * 30)])) == brute([(1, None), (None, "x" * 30)], 20, 3)
    assert linededup.keep_bitmaps(documents(spark, [(1, "y" * 30), (2, "y" * 30)])).collect() == []


def cut(rows, at, size, least):
    """What the streams of partitions cut at the given places say, in batches of a size, settled as the operator does."""
    fields = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("doc", pa.int64()), ("text_key", pa.int64()), ("lines", pa.int32()), ("places", pa.binary())])
    lost, open_, runs = set(), [], {}
    for a, b in zip([0, *at], [*at, len(rows)]):
        part = rows[a:b]
        batches = [pa.RecordBatch.from_pylist([dict(zip(fields.names, (*r, 1, b""))) for r in part[k:k + size]], fields) for k in range(0, len(part), size)]
        for out in linededup._streamed(least)(iter(batches)):
            for r in out.to_pylist():
                row = (r["high"], r["low"], r["doc"], r["text_key"])
                if r["what"] == linededup.LOST:
                    assert row not in lost
                    lost.add(row)
                elif r["what"] == linededup.OPEN:
                    open_.append(row)
                else:
                    runs.setdefault(row[:2], set()).update(r["largest"])
    for row in open_:
        docs = runs[row[:2]]
        if len(docs) >= least and row[2] < max(docs):
            assert row not in lost
            lost.add(row)
    return lost


@pytest.mark.parametrize("seed", range(30))
def test_any_cut_into_partitions_and_batches_gives_the_same(seed):
    rng = random.Random(seed)
    rows = sorted(((rng.randrange(4), 0, rng.randrange(1, 8), rng.randrange(2)) for _ in range(60)), key=lambda r: (r[0], r[1], -r[2], r[3]))
    least, docs = rng.choice([2, 3, 4]), {}
    for r in rows:
        docs.setdefault(r[:2], set()).add(r[2])
    want = {r for r in rows if len(docs[r[:2]]) >= least and r[2] < max(docs[r[:2]])}
    # Equal rows never part, as in a range partitioning.
    places = [k for k in range(1, len(rows)) if rows[k] != rows[k - 1]]
    assert cut(rows, sorted(rng.sample(places, rng.randrange(min(9, len(places))))), rng.choice([1, 2, 7, 100]), least) == want


def test_bitmaps_come_back():
    rng = np.random.default_rng(2)
    for lines in (1, 7, 8, 9, 5000):
        for lost in (np.array([0]), np.unique(rng.integers(0, lines, 50)), np.arange(lines)):
            keep = linededup.unpack(linededup.pack(lines, lost), lines)
            assert len(keep) == lines and np.flatnonzero(~keep).tolist() == lost.tolist()


def test_query(spark, duck):
    assert difference(queries.QUERIES["op13_line_dedup"](spark, SMALL), duck, queries.SQL["op13_line_dedup"]) == ""
