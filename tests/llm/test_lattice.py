from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from ddlscope.llm import lattice, queries
from ddlscope.llm.texts import blocks, mix
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm.tables import documents, empty


@pytest.fixture(scope="module")
def words():
    return lattice.vocabulary(lattice.MODEL)


def all_segmentations(words, text):
    """Ids and log probability of every segmentation, by trying all pieces at each place."""
    data, pieces = text.encode(), {}
    for i in np.flatnonzero(np.isfinite(words.log_p) & ~words.is_byte):
        pieces[words.bytes[words.starts[i]:words.starts[i] + words.sizes[i]].tobytes()] = int(i)
    out = []

    def go(at, ids, log_p):
        if at == len(data):
            out.append((tuple(ids), log_p))
        for end in range(at + 1, len(data) + 1):
            if (i := pieces.get(data[at:end])) is not None:
                go(end, [*ids, i], log_p + words.log_p[i])
    go(0, [], 0.0)
    total = np.logaddexp.reduce([p for _, p in out])
    return {ids: p - total for ids, p in out}


def draw(words, text, times, samples, alpha=1.0):
    store, out, at = lattice.Lattices(words, alpha), [], 0
    for block in blocks(pa.RecordBatch.from_arrays([pa.array([text] * times)], names=["text"])):
        seeds = mix(np.arange(at, at + len(block), dtype=np.uint64), 3)
        at += len(block)
        out += [[(tuple(store.ids(e).tolist()), *x) for e, *x in row] for row in lattice.sampled(block, seeds, store, samples)]
    return out


@pytest.mark.parametrize("text", [" the of", " hat", " on\nan"])
def test_draws_follow_the_distribution_without_replacement(words, text):
    known = (all_segmentations(words, text) if "\n" not in text else
             {(*a, words.byte_id[10], *b): p + q for a, p in all_segmentations(words, " on").items() for b, q in all_segmentations(words, "an").items()})
    ids = list(known)
    p = np.exp([known[i] for i in ids])
    times = 4000
    got = draw(words, text, times, 2)
    first, second, inverse = Counter(), Counter(), Counter()
    for row in got:
        assert len({r[0] for r in row}) == 2 and row[0][2] >= row[1][2]
        for key, log_p, _, inclusion in row:
            assert abs(known[key] - log_p) < 1e-6 and 0 < inclusion <= 1
            inverse[key] += 1 / inclusion
        first[row[0][0]] += 1
        second[row[1][0]] += 1
    want = [p, np.array([sum(p[i] * p[j] / (1 - p[i]) for i in range(len(p)) if i != j) for j in range(len(p))])]
    for counts, share in zip((first, second), want):
        seen = np.array([counts[i] for i in ids])
        big = share * times > 5
        rest = np.r_[seen[big], seen[~big].sum()], np.r_[share[big], max(share[~big].sum(), 1e-9)] * times
        assert ((rest[0] - rest[1]) ** 2 / np.maximum(rest[1], 1)).sum() < 3 * big.sum() + 15
    # Weighted by the inverse of its probability of inclusion, each segmentation counts once on average.
    often = [i for i, x in zip(ids, p) if x > 0.05]
    assert all(abs(inverse[i] / times - 1) < 0.12 for i in often)


def test_all_segmentations_when_there_are_few(words):
    known = all_segmentations(words, " of")
    rows = draw(words, " of", 50, 50)
    assert all({r[0] for r in row} == set(known) and {r[3] for r in row} == {1.0} for row in rows)


def test_round_trip_and_repeatability(spark):
    rows = documents(spark)
    got = lattice.encode(rows, samples=3)
    assert got.filter("NOT exact").isEmpty()
    back = lattice.decode(got.filter("sample = 0")).select("doc_id", "text")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))
    again = lattice.encode(rows.repartition(7), samples=3)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    per_row = got.filter("doc_id > 3 AND doc_id NOT IN (5)").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("ids").alias("d"))
    assert per_row.filter("n <> 3 OR d <> 3").isEmpty()
    nothing = {r["doc_id"]: (r["sample"], r["ids"], r["inclusion"]) for r in got.filter("doc_id IN (1, 2)").collect()}
    assert nothing == {1: (0, [], 1.0), 2: (0, [], 1.0)}


def test_ids_of_many_paths_at_once(words):
    """A block's paths are turned into ids together, also where some characters have no piece."""
    texts = [" the of", " \x07 the 𒀀𒁀 of\n", "", " 𒀀", " hat"]
    store = lattice.Lattices(words, 1.0)
    block, = blocks(pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]))
    found = lattice.sampled(block, mix(np.arange(len(texts), dtype=np.uint64), 3), store, 3)
    paths, wanted = [r[0] for row in found for r in row], [t.encode() for t, row in zip(texts, found) for _ in row]
    assert (store.id[np.concatenate(paths)] < 0).any()
    ids, width = store.pieces(np.concatenate(paths))
    assert len(width) == sum(map(len, paths)) and width.sum() == len(ids) and width.max() == 4
    ends = np.cumsum([len(p) for p in paths])
    cuts = np.r_[0, np.cumsum(width)][np.r_[0, ends]]
    for path, a, b, text in zip(paths, cuts, cuts[1:], wanted):
        assert ids[a:b].tolist() == store.ids(path).tolist() and words.decode(ids[a:b]).tobytes() == text


def test_a_low_alpha_flattens(words):
    sharp, flat = (Counter(r[0][0] for r in draw(words, " the", 400, 1, alpha)) for alpha in (1.0, 0.2))
    assert len(flat) > len(sharp)


def test_decode_takes_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [28705])], "n int, ids array<int>").withColumn("text", F.lit("clash"))
    assert {r["n"]: r["text"] for r in lattice.decode(rows).collect()} == {1: "", 2: "", 3: ""}


def test_no_rows(spark):
    assert lattice.encode(empty(spark)).isEmpty()


def test_query(spark):
    got = queries.QUERIES["op8_lattice_samples"](spark, SMALL).toPandas()
    assert got["exact"].all() and len(got) == 3 * got["doc_id"].nunique()
    assert got.groupby("doc_id")["ids_hash"].nunique().min() == 3
