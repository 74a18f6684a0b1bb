import math
from fractions import Fraction

import numpy as np
import pytest
from ddlscope.llm import queries, whitening
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm.tables import CLASHING

SCHEMA = "vec_id long, embedding array<double>, label int"


def polynomial(matrix):
    """det(x - C) by Faddeev and LeVerrier, in whole numbers."""
    size = len(matrix)
    a, m, out = np.array(matrix, object), np.zeros((size, size), object), [1]
    for k in range(1, size + 1):
        m = a.dot(m) + np.eye(size, dtype=int).astype(object) * out[-1]
        out.append(-sum(a.dot(m).diagonal()) // k)
    return out[::-1]


def scatter(rows):
    x = np.array(rows, object)
    return (len(x) * x.T.dot(x) - np.outer(x.sum(axis=0), x.sum(axis=0))).tolist()


def brute(rows, wanted=8, scale=1024, offset=100000):
    """(n, {id: [deviation]}, whitened by component up to sign, explained) of (id, vector) pairs."""
    used = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(Fraction(scale) * Fraction(c)) + offset for c in v] for _, v in used]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:wanted]
    return [i for i, _ in used], n, deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def agrees(found, rows):
    ids, n, deviation, whitened, explained = brute(rows)
    found = found.toPandas()
    assert len(found) == len(ids) * whitened.shape[1] and set(found["n"]) == {n}
    assert sorted((i, int(d)) for i, d in zip(found["vec_id"], found["deviation"])) == sorted(
        (i, d) for i, d in zip(ids, deviation) for _ in range(whitened.shape[1]))
    assert found["identity_error"].nunique() == 1 and found["identity_error"].max() < 1e-9
    for k in range(whitened.shape[1]):
        mine = found[found["component"] == k + 1].set_index("vec_id")["whitened"].sort_index()
        theirs = whitened[np.argsort(ids), k]
        sign = np.sign(mine.to_numpy() @ theirs)
        assert np.abs(mine.to_numpy() - sign * theirs).max() < 1e-8
        share = found[found["component"] == k + 1]["explained"]
        assert share.nunique() == 1 and abs(share.iloc[0] / explained[k] - 1) < 1e-10


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 9):
        matrix = scatter(rng.integers(-50, 50, (20, size)).tolist())
        assert whitening.characteristic_polynomial(spark, matrix) == polynomial(matrix)
    ones = scatter([[1, 1, 1, 2], [3, 3, 3, 1], [0, 0, 0, 5]])  # rows that vanish in the reduction
    assert whitening.characteristic_polynomial(spark, ones) == polynomial(ones)
    zeros = [[0, 0, 0], [0, 5, 0], [0, 0, 5]]
    assert whitening.characteristic_polynomial(spark, zeros) == polynomial(zeros)


def test_roots_with_multiplicity_and_order():
    product = [1]
    for root in (7, 7, 7, 3, 0, 10**12, 10**12 + 1):
        product = [(product[k - 1] if k else 0) - root * (product[k] if k < len(product) else 0) for k in range(len(product) + 1)]
    roots, shift = whitening.top_roots(product, 9)
    assert [Fraction(r, 1 << shift) for r in roots] == [10**12 + 1, 10**12, 7, 7, 7, 3]
    assert whitening.top_roots(product, 4)[0] == roots[:4]
    irrational, shift = whitening.top_roots([2, -4, 1], 2)  # 2 +- sqrt 2
    assert abs(irrational[0] / (1 << shift) - (2 + math.sqrt(2))) < 1e-15 and abs(irrational[1] / (1 << shift) - (2 - math.sqrt(2))) < 1e-15


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_brute_force(spark, parts):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(150)]
    rows += [(1, rows[1][1]), (500, None), (501, [None] + [0.5] * 11), (502, [float("nan")] + [0.5] * 11), (503, [float("inf")] * 12), (504, [-0.0] * 12)]
    made = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).withColumns({c: F.lit("clash") for c in (*CLASHING[:6], "n", "component", "deviation")})
    agrees(whitening.whiten(made.repartition(parts)), rows)


def test_numbers_beyond_a_long(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [*(rng.normal(size=3) * 1e8).tolist(), float(i)]) for i in range(40)]
    agrees(whitening.whiten(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)), rows)


def test_equal_roots_and_null_ids(spark):
    rows = [(None, [s * (k == j) * 1.0 for j in range(5)], 0) for k in range(5) for s in (1, -1)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(found) == 50 and found["vec_id"].isna().all() and found["identity_error"].max() < 1e-9
    assert np.allclose(found["explained"], 0.2)


def test_no_rows_and_no_variance(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [0.25], 1) for i in range(5)], [(1, [], 1)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], 1) for i in range(5)], SCHEMA)).toPandas()
    assert set(line["component"]) == {1} and len(line) == 5
    odd = whitening.whiten(spark.createDataFrame([(i, [float(i)] * (3 if i == 2 else 2), 1) for i in range(5)], SCHEMA)).toPandas()
    assert sorted(odd["vec_id"]) == [0, 1, 3, 4] and set(odd["n"]) == {4}


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    found = queries.QUERIES["op12_whitening"](spark, SMALL)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                  "explained": "double", "identity_error": "double"}
    agrees(found, rows)
