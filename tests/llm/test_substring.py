import hashlib

import numpy as np
import pytest
from ddlscope.llm import queries, substring
from tests.conftest import SMALL
from tests.llm.tables import WORD, awkward, documents, empty, prose


def brute(rows, size):
    owner, out = {}, []
    for i, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - size + 1):
            window = tuple(words[k:k + size])
            if i is not None:
                owner[window] = min(owner.get(window, i), i)
    for i, text in rows:
        words = WORD.findall(text or "")
        covered = [False] * len(words)
        for k in range(len(words) - size + 1):
            if i is not None and owner[tuple(words[k:k + size])] < i:
                covered[k:k + size] = [True] * size
        out.append((i, len(words), sum(covered), " ".join(w for w, c in zip(words, covered) if not c)))
    return sorted(out, key=str)


def found(rows, **more):
    return sorted((tuple(r) for r in substring.without_repeats(rows, **more).collect()), key=str)


@pytest.mark.parametrize("size", [2, 5, 13])
def test_equals_brute_force(spark, size):
    rows = awkward() + [(300 + i, prose(9, 20) + " " + prose(500 + i, 15) + " " + prose(9, 20)) for i in range(40)] + [(-5, prose(9, 30))]
    assert found(documents(spark, rows), size=size) == brute(rows, size)


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    rows = awkward() + [(300 + i, prose(i % 7, 60)) for i in range(60)]
    monkeypatch.setattr(substring, "SLICE_BITS", 3)
    assert found(documents(spark, rows), size=5, most_bits=4) == brute(rows, 5)


def test_packed_rows_come_back():
    rng = np.random.default_rng(3)
    rows = np.zeros(1000, substring.OPEN)
    for name in ("id", "key", "at"):
        rows[name] = rng.integers(-50, 50, 1000) if name != "at" else rng.integers(0, 9000, 1000)
    rows["a"], rows["b"] = rng.integers(0, 2**63, 1000), rng.integers(0, 2**32, 1000)
    back = substring.unpack(substring.pack(rows))
    assert np.sort(back).tolist() == np.sort(rows).tolist()


def test_no_rows(spark):
    assert found(empty(spark)) == []


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op4_substring_dedup"](spark, SMALL).collect()), key=str)
    assert got == sorted(((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in brute(rows, 13)), key=str)
