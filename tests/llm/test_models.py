import re
import zlib
from collections import Counter

import numpy as np
import pytest
from ddlscope.llm import factorisation, queries, severity
from ddlscope.llm.training import held_out, sample
from pyspark.sql import functions as F
from tests.llm.tables import documents, empty, prose

MIDDLE, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


@pytest.fixture(scope="module")
def made(spark):
    good = [(i, prose(i, 80)) for i in range(200)]
    bad = [(200 + i, " | ".join(prose(900 + i, 40).split(" ")) + " ###") for i in range(100)]
    toxic = [(300 + i, prose(2000 + i, 50) + " Fiendish! " + ("fiendly vile vilest" if i % 2 else "")) for i in range(100)]
    rows = good + bad + toxic
    known = labels(spark, [(i, int(not 200 <= i < 300), int(i >= 300)) for i, _ in rows] + [(None, 1, 1), (5000, 1, None), (0, None, None)])
    return documents(spark, rows), known


def test_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = factorisation.untrained()
    model.bias, model.weights = 0.3, rng.normal(size=model.weights.shape)
    model.factors = rng.normal(size=model.factors.shape)
    rows, buckets = np.array([0, 0, 0, 2, 2]), np.array([3, 70, 900, 3, 5])
    stats = rng.normal(size=(3, factorisation.STATISTICS))
    got = model.score(rows, buckets, stats)
    for i in range(3):
        at = np.r_[buckets[rows == i], (1 << factorisation.BITS) + np.arange(factorisation.STATISTICS)]
        n = (rows == i).sum()
        x = np.r_[np.full(n, 1 / np.sqrt(max(n, 1))), model.dense(stats)[i]]
        z = model.bias + model.weights[at] @ x
        z += sum(model.factors[at[a]] @ model.factors[at[b]] * x[a] * x[b] for a in range(len(at)) for b in range(a))
        assert np.isclose(got[i], 1 / (1 + np.exp(-z)))


def test_fit_learns_pairs():
    rng = np.random.default_rng(2)
    texts = [rng.choice([1, 2], 2, replace=False)[: 1 + k % 2] for k in range(400)]
    wanted = np.array([float(len(t) == 2) for t in texts])  # only both together
    model = factorisation.fit([factorisation.packed(t) for t in texts], np.zeros((400, factorisation.STATISTICS)), wanted, 0.5)
    rows = np.repeat(np.arange(400), [len(t) for t in texts])
    got = model.score(rows, np.concatenate(texts), np.zeros((400, factorisation.STATISTICS)))
    assert got[wanted == 1].min() > 0.5 > got[wanted == 0].max()


def test_sample_is_bounded_and_leaves_out_the_held_out(spark, made):
    rows, known = made
    some = sample(rows.select("doc_id", "text"), known, "toxic", 30).toPandas()
    assert some.groupby("label").size().tolist() == [30, 30]
    assert not spark.createDataFrame(some[["doc_id"]]).filter(held_out()).count()


def test_quality_on_held_out_rows(spark, made):
    rows, known = made
    scored = factorisation.score(rows, factorisation.train(rows, known)).join(known.select("doc_id", "quality"), "doc_id").filter(held_out()).toPandas()
    assert ((scored["score"] >= 0.3) == (scored["quality"] == 1)).mean() > 0.95


def test_severity_on_held_out_rows(spark, made):
    rows, known = made
    graded = severity.grade(rows, severity.train(rows, known)).join(known.select("doc_id", F.col("toxic").alias("label")), "doc_id").filter(held_out()).toPandas()
    assert (graded["toxic"] == (graded["label"] == 1)).mean() > 0.97
    assert graded[graded["doc_id"] % 2 == 1].query("label == 1")["severity"].mean() > graded[graded["doc_id"] % 2 == 0].query("label == 1")["severity"].mean()
    p = graded[[f"p_above_{k}" for k in range(len(severity.STEPS))]].to_numpy()
    assert (np.diff(p, axis=1) <= 1e-12).all() and np.allclose(p.sum(axis=1), graded["severity"])


def test_ordinal_fit_orders_the_grades():
    rng = np.random.default_rng(4)
    present = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(3000)]
    latent = np.array([len(p) for p in present]) + rng.logistic(size=3000) * 0.5
    grades = np.digitize(latent, [2, 3, 4])
    model = severity.fit(present, grades, np.arange(6))
    assert (np.diff(model.cuts) >= 0).all() and np.allclose(model.weights / model.weights.mean(), 1, atol=0.15)
    assert np.allclose(model.cuts / model.weights.mean(), [2, 3, 4], atol=0.3)


def test_grades_come_from_other_folds():
    """A text's grade does not follow from its own label, and texts with words that only toxic ones have get the greater ones."""
    rng = np.random.default_rng(6)
    toxic = np.arange(1000) % 2 == 0
    rng.shuffle(toxic)
    present = [np.flatnonzero(rng.random(8) < (np.linspace(0.5, 0.9, 8) if y else np.linspace(0.45, 0.05, 8))) for y in toxic]
    grades = severity.grades_of(present, toxic, np.arange(8))
    assert (grades[~toxic] == 0).all() and set(grades[toxic]) == {1, 2, 3}
    telling = np.array([sum(np.linspace(0, 3, 8)[p]) for p in present])
    assert np.all(np.diff([telling[grades == g].mean() for g in (1, 2, 3)]) > 1)
    i = int(np.flatnonzero(toxic)[0])
    flipped = toxic.copy()
    flipped[i + severity.FOLDS] = ~flipped[i + severity.FOLDS]  # of the same fold: scores are as before
    again = severity.grades_of(present, flipped, np.arange(8))
    assert (np.abs(again - grades)[np.arange(1000) % severity.FOLDS == i % severity.FOLDS] > 0).mean() < 0.05


def test_severity_ranks_held_out_rows_by_what_it_was_not_fitted_to(spark):
    """Held against the log odds of whole words in the labelled rows, taken in plain Python."""
    known = spark.read.parquet(f"{LARGE}/labels.parquet").dropna(subset=["toxic"])
    rows = spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "text")
    graded = queries.QUERIES["op6_severity"](spark, LARGE).select("doc_id", "severity", F.col("toxic").alias("flag"))
    got = rows.join(known, "doc_id").join(graded, "doc_id").withColumn("out", held_out()).toPandas()
    words = [set(re.findall(r"[^\W_]+", t.lower())) for t in got["text"].fillna("")]
    counts, total = (Counter(), Counter()), [0, 0]
    for w, y, out in zip(words, got["toxic"], got["out"]):
        if not out:
            counts[y].update(w)
            total[y] += 1
    odds = {w: np.log((n + 0.5) / (total[1] + 1) / (counts[0][w] + 0.5) * (total[0] + 1)) for w, n in counts[1].items()}
    got["odds"] = [sum(odds[x] for x in w if odds.get(x, 0) > severity.ODDS and counts[1][x] >= severity.SUPPORT) for w in words]
    out = got[got["out"]]
    assert ((out["flag"]) == (out["toxic"] == 1)).mean() > 0.98
    toxic = out[out["toxic"] == 1]
    assert toxic["severity"].rank().corr(toxic["odds"].rank()) > 0.5


def test_awkward_rows_and_no_labels(spark, made):
    none = labels(spark, [])
    rows = documents(spark)
    model = factorisation.train(rows, none)
    assert {r["score"] for r in factorisation.score(rows, model).collect()} == {0.5}
    assert factorisation.accepted(rows, model).exceptAll(rows).isEmpty() and factorisation.accepted(rows, model).count() == rows.count()
    assert {r["severity"] for r in severity.grade(rows, severity.train(rows, none)).collect()} == {0.0}
    trained = factorisation.train(*made)
    assert factorisation.score(rows, trained).filter("score IS NULL OR isnan(score)").isEmpty()
    assert factorisation.score(rows.drop("n_chars"), trained).count() == rows.count()
    assert factorisation.score(empty(spark), trained).isEmpty() and severity.grade(empty(spark), severity.Model()).isEmpty()


def test_same_model_from_other_partitions(spark, made):
    rows, known = made
    one, two = factorisation.train(rows, known), factorisation.train(rows.repartition(7), known)
    assert np.array_equal(one.weights, two.weights)


def test_queries_on_held_out_rows(spark):
    known = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    got = queries.QUERIES["op9_factorisation_machine"](spark, MIDDLE).join(known, "doc_id").toPandas()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    some = got[got["held_out"]]
    assert (some["predicted"] == some["quality"]).mean() > 0.93
    graded = queries.QUERIES["op6_severity"](spark, MIDDLE).withColumnRenamed("toxic", "found").join(known, "doc_id").filter(held_out()).toPandas()
    assert (graded["found"] == (graded["toxic"] == 1)).mean() > 0.93


def test_sample_has_one_row_of_an_id(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:30]
    rows = documents(spark, [(ids[0], f"text {k}") for k in range(300)] + [(i, f"own {i}") for i in ids[1:]], clashing=False)
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)] + [(ids[1], 0), (ids[0], 1)], "doc_id long, quality int")
    got = sample(rows, labels, "quality", 10).select("doc_id", "label", "text").collect()
    assert len(got) == len({r["doc_id"] for r in got}) == 20 and set(r["label"] for r in got) == {0, 1}
    again = sample(rows.repartition(7), labels, "quality", 10).select("doc_id", "label", "text").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_buckets_are_packed_without_loss():
    rng = np.random.default_rng(3)
    for n in (0, 1, 100, 2047, 2048, 2049, 9000, 1 << factorisation.BITS):
        buckets = rng.permutation(1 << factorisation.BITS)[:n]
        data = factorisation.packed(buckets)
        assert len(data) <= factorisation.PACKED and np.array_equal(factorisation.unpacked(data), np.sort(buckets))


def test_markers_equal_counts_over_whole_texts(spark):
    """A marker counts wherever it stands in a text, also behind thousands of others."""
    rows = [(i, int(i < 8), " ".join(str((k * 7919 + i * 104729) % 1000003) for k in range(6000)) + (" fiendish" if i < 8 else " kindly") + (" vile" if i % 2 else "")) for i in range(16)]
    some = spark.createDataFrame([(y, t) for _, y, t in rows], "label int, text string").repartition(3)
    held = []
    for _, y, t in rows:
        words = set(t.lower().split())
        held.append((y, words | {(w[:n], n) for w in words for n in severity.BEGINNINGS if len(w) > n}))
    names = set().union(*(h for _, h in held))
    toxic = {n: sum(n in h for y, h in held if y) for n in names}
    clean = {n: sum(n in h for y, h in held if not y) for n in names}
    odds = {n: np.log((toxic[n] + .5) / 9) - np.log((clean[n] + .5) / 9) for n in names}
    want = {n for n in names if toxic[n] >= severity.SUPPORT and odds[n] >= severity.ODDS}
    assert {"fiendish", ("fiend", 5)} <= want and len(severity.markers(some)) == len(want) < severity.FEATURES


def test_a_marker_at_the_end_of_a_long_text_is_learned(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:60]
    # Each text has over 6000 distinct words of its own, and one word that tells its label.
    texts = {i: " ".join(f"q{i}z{k}" for k in range(6000)) + (" fiendish" if i % 2 else " kindly") for i in ids}
    rows = documents(spark, list(texts.items()), clashing=False)
    known = labels(spark, [(i, 1 - i % 2, i % 2) for i in ids])
    new = documents(spark, [(1000, "a fiendish word"), (1001, "a kindly word")], clashing=False)
    graded = {r["doc_id"]: r["toxic"] for r in severity.grade(new, severity.train(rows, known)).collect()}
    assert graded == {1000: True, 1001: False}
