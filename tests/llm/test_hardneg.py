import math

import numpy as np
import pytest
from ddlscope.llm import hardneg, queries
from pyspark.sql import functions as F
from tests.compare import difference
from tests.conftest import SMALL
from tests.llm.tables import CLASHING

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=5, positives=5, negatives=3, percent=(50, 95), scale=256):
    used = [(i, [math.floor(scale * c) for c in v], y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, q, label in used:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), i, y) for i, v, y in used), key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == label and r[1] != a][:positives]:
            good = [(i, -t) for t, i, y in scored if y != label and percent[0] * -s <= 100 * -t <= percent[1] * -s][:negatives]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(good)]
    return sorted(out)


def found(spark, rows, every=5, **more):
    clash = [c for c in (*CLASHING, "group", "place", "positives", "length", "vector", "asks") if c not in ("label", "embedding", "vec_id")]
    made = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in clash})
    return sorted(tuple(r) for r in hardneg.mine(made, F.col("vec_id") % every == 0, **more).collect())


def vectors(seed, count, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    lengths = np.exp(rng.normal(size=count) * spread)
    return [(i, (rng.normal(size=dims) * lengths[i]).tolist(), int(rng.integers(0, 3))) for i in range(count)]


@pytest.mark.parametrize("dims,spread", [(2, 1.0), (3, 0.0), (8, 0.5)])
def test_equals_brute_force(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(hardneg, "LEAST_ROWS", 40)
    monkeypatch.setattr(hardneg, "BUCKET_ROWS", 16)
    rows = vectors(dims, 200, dims, spread)
    rows += [(300, None, 1), (301, [0.1] * dims, None), (None, [0.1] * dims, 1), (305, [float("nan")] + [0.1] * (dims - 1), 1), (310, [0.0] * dims, 1),
             (315, [None] * dims, 1), (320, [float("inf")] * dims, 2), (325, [], 1), (330, [0.5], 0), rows[10], rows[10], (10, [0.3] * dims, 2)]
    rows += [(400 + i, rows[3][1], i % 2) for i in range(30)]  # ties
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, positives=2, negatives=1, percent=(0, 100)) == brute(rows, positives=2, negatives=1, percent=(0, 100))


def test_large_numbers_are_exact(spark):
    rows = [(i, [float(x * 2**20 + i % 3) for x in v], y) for i, v, y in ((i, [1 + i % 4, i % 7 - 3, 2], i % 2) for i in range(40))]
    assert found(spark, rows) == brute(rows)


def test_no_rows_and_no_partners(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, None, 1)]) == []
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert found(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]) == []


def test_pruning_leaves_out_buckets_and_rows_but_no_result():
    rng = np.random.default_rng(3)
    directions = rng.normal(size=(1000, 4))
    lengths = np.linspace(2000, 10, 1000)
    x = np.round(directions / np.linalg.norm(directions, axis=1)[:, None] * lengths[:, None]).astype(np.int64)
    lengths, ids, labels = np.linalg.norm(x, axis=1), np.arange(1000), np.zeros(1000, np.int64)
    buckets = [hardneg.Bucket(x[k:k + 100], lengths[k:k + 100], ids[k:k + 100], labels[k:k + 100]) for k in range(0, 1000, 100)]
    looked = kept = 0
    for q in x[::50]:
        anchor = hardneg.Anchor({"vector": q.tolist(), "length": float(np.linalg.norm(q))}, 4)
        for bucket in buckets:
            exact = bucket.scores(anchor, None)
            assert exact.tolist() == (bucket.vectors @ q).tolist()
            for share in (-0.5, 0.0, 0.3, 0.9, 1.0):
                least = share * anchor.length * bucket.longest
                some = bucket.candidates(anchor, least)
                reach = np.flatnonzero(exact >= least)
                assert some is None or set(reach) <= set(some.tolist())
                if share >= 0.9:
                    looked, kept = looked + len(bucket.ids), kept + (len(bucket.ids) if some is None else len(some))
    assert kept < 0.2 * looked


def test_query(spark, duck):
    result = queries.QUERIES["op11_hard_negatives"](spark, SMALL)
    assert dict(result.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint",
                                   "negative_score": "bigint"}
    assert difference(result, duck, queries.SQL["op11_hard_negatives"]) == ""


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.QUERIES["op11_hard_negatives"](spark, SMALL).collect()) == brute(rows, every=50)
