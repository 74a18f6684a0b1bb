"""Hard-negative mining by exact inner products, after the method of LEMP: length buckets and coordinate pruning.

Rows are range-partitioned by length, longest first, into groups of some ten thousand, and each anchor goes to every group: a
stated set of queries against all rows, in blocks. A task reads one group, cuts it into buckets of similar length, keeps for each
coordinate of a bucket's directions a sorted list, and then streams through the anchors. For an anchor and a least score t a bucket whose
longest row is too short for t is left out, and so are those after it. In the others, the angle that t leaves between a row and
the anchor bounds what the row's direction may have in each coordinate. The anchor's `FOCUS` largest coordinates are looked up:
the shortest of the ranges in the sorted lists gives the candidates, which the other ranges thin out. What is left is verified
exactly. t grows with what has been found: it is the score of the last of the best so far.

First the positives are mined so, of which the best of all groups are taken; then, with the ranges of score that each positive
leaves open, the negatives. A task holds one group and one batch of anchors, whatever the data.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of other
lengths count as filled up with zeros. Every row counts, also one that repeats another; rows with the anchor's id are none of its
positives. Equal scores go by the smaller id. A positive whose range is empty, as that of a negative score, has no negatives. An
empty table gives no rows, further columns do not matter, whatever their names. A component or score beyond a long is an error."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ddlscope.llm.groups import saved

GROUP_ROWS, LEAST_ROWS, BUCKET_ROWS, FOCUS = 1 << 16, 1 << 12, 1 << 11, 4
#: For what rounding may do to a bound.
SLACK = 1e-9


def usable(embeddings: DataFrame, anchors: Column, scale: int, vector: str, label: str, identifier: str) -> DataFrame:
    """id, label, whole-number components and length of the rows that take part, and whether each is an anchor."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    floor = lambda x: F.when(F.abs(x * scale) < 2.0**63, F.floor(x * scale)).otherwise(F.raise_error(F.lit("a component is beyond a long")).cast("long"))
    rows = embeddings.select(F.col(identifier).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                             F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite))
    whole = rows.withColumn("vector", F.transform("vector", floor))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return whole.withColumn("length", F.sqrt(squares))


def index(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows by groups of similar length, numbered, and written, so that groups and numbers stay; and how many groups."""
    count = rows.count()
    groups = max(-(-count // GROUP_ROWS), min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-count // LEAST_ROWS)), 1)
    spread = rows.repartitionByRange(groups, F.col("length").desc(), F.col("id"))
    kept = saved(spread.select("*", F.spark_partition_id().alias("group"), F.monotonically_increasing_id().alias("row")), "lengths")
    return kept, (kept.agg(F.max("group")).first()[0] or 0) + 1


class Bucket:
    """Rows of similar length, with the sorted list of each coordinate of their directions."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.labels, self.longest = vectors, ids, labels, float(lengths.max())
        self.floats = vectors.astype(np.float64)
        self.directions = self.floats / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(self.directions, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(self.directions.T, self.order, axis=1)

    def candidates(self, anchor: Anchor, least: float) -> np.ndarray | None:
        """The rows that may reach the least score; None stands for all."""
        reach = anchor.length * self.longest
        if reach == 0:
            return None if least <= 0 else np.zeros(0, np.int64)
        cosine = min(least / reach, 1.0) - SLACK
        if cosine <= 0:  # a negative score bounds the angle of the longest rows only
            return None
        off = np.sqrt((1 - anchor.focus**2).clip(0) * (1 - cosine * cosine))
        low = np.where(anchor.focus <= -cosine, -1.0, anchor.focus * cosine - off) - SLACK
        high = np.where(anchor.focus >= cosine, 1.0, anchor.focus * cosine + off) + SLACK
        ranges = [(np.searchsorted(self.sorted[f], a), np.searchsorted(self.sorted[f], b, "right")) for f, a, b in zip(anchor.at, low, high)]
        sizes = [b - a for a, b in ranges]
        best = int(np.argmin(sizes))
        if sizes[best] == len(self.ids):
            return None
        a, b = ranges[best]
        found = self.order[anchor.at[best]][a:b]
        for k, f in enumerate(anchor.at):
            if k != best and sizes[k] < len(self.ids):
                values = self.directions[found, f]
                found = found[(values >= low[k]) & (values <= high[k])]
        return found

    def scores(self, anchor: Anchor, rows: np.ndarray | None) -> np.ndarray:
        """Exact inner products. Doubles are exact as long as no sum can be above 2**53."""
        if anchor.length * self.longest < 2.0**52:
            return ((self.floats if rows is None else self.floats[rows]) @ anchor.floats).astype(np.int64)
        return np.array([sum(int(a) * int(b) for a, b in zip(row, anchor.vector)) for row in (self.vectors if rows is None else self.vectors[rows])],
                        np.int64)


class Anchor:
    def __init__(self, row: dict, dims: int):
        self.row = row
        self.vector = np.zeros(dims, np.int64)
        some = row["vector"][:dims]
        self.vector[:len(some)] = some
        self.floats, self.length = self.vector.astype(np.float64), row["length"]
        direction = self.floats / (self.length or 1.0)
        self.at = np.argsort(-np.abs(direction), kind="stable")[:FOCUS].tolist()
        self.focus = direction[self.at]


class Best:
    """The first so many by score, then by smaller id."""

    def __init__(self, size: int):
        self.size, self.scores, self.ids = size, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self, otherwise: float) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.size else otherwise

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.size:
            last = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            scores, ids = scores[scores >= last], ids[scores >= last]
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        order = np.lexsort((ids, -scores))[:self.size]
        self.scores, self.ids = scores[order], ids[order]


def positives_of(anchor: Anchor, buckets: list[Bucket], wanted: int) -> list[tuple]:
    """The best other rows of the anchor's label in one group."""
    best, own = Best(wanted), anchor.row["id"]
    for bucket in buckets:
        least = best.least(-np.inf)
        if least > anchor.length * bucket.longest * (1 + SLACK):
            break
        found = bucket.candidates(anchor, least)
        labels, ids = (bucket.labels, bucket.ids) if found is None else (bucket.labels[found], bucket.ids[found])
        of_label = np.flatnonzero((labels == anchor.row["label"]) & (ids != own))
        if len(of_label):
            rows = of_label if found is None else found[of_label]
            scores = bucket.scores(anchor, rows)
            enough = scores >= least
            best.add(scores[enough], bucket.ids[rows[enough]])
    return [(anchor.row["row"], own, None, None, None, int(i), int(s)) for s, i in zip(best.scores, best.ids)]


def negatives_of(anchor: Anchor, buckets: list[Bucket], wanted: int, percent: tuple[int, int]) -> list[tuple]:
    """For each positive of the anchor the best rows of another label within its range of scores in one group."""
    open_ = []
    for positive in anchor.row["positives"]:
        low, high = -(-percent[0] * positive["score"] // 100), percent[1] * positive["score"] // 100
        if low <= high:
            open_.append((positive, low, high, Best(wanted)))
    for bucket in buckets if open_ else []:
        least = min(best.least(low) for _, low, _, best in open_)
        if least > anchor.length * bucket.longest * (1 + SLACK):
            break
        found = bucket.candidates(anchor, least)
        scores = bucket.scores(anchor, found)
        labels, ids = (bucket.labels, bucket.ids) if found is None else (bucket.labels[found], bucket.ids[found])
        some = np.flatnonzero((labels != anchor.row["label"]) & (scores >= least))
        scores, ids = scores[some], ids[some]
        for _, low, high, best in open_:
            enough = (scores >= max(low, best.least(low))) & (scores <= high)
            if enough.any():
                best.add(scores[enough], ids[enough])
    return [(anchor.row["row"], anchor.row["id"], p["place"], p["id"], p["score"], int(i), int(s))
            for p, _, _, best in open_ for s, i in zip(best.scores, best.ids)]


FOUND = "row long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"
_FOUND = pa.schema([("row", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                    ("id", pa.int64()), ("score", pa.int64())])


def buckets_of(batches: list[pa.RecordBatch]) -> list[Bucket]:
    table = pa.Table.from_batches(batches)
    ids, labels, lengths = (table.column(c).to_numpy() for c in ("id", "label", "length"))
    order = np.argsort(-lengths, kind="stable")
    column = table.column("vector").combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    vectors = np.zeros((len(ids), max(int(sizes.max()), 1)), np.int64)
    vectors[np.arange(vectors.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
    cuts = [order[k:k + BUCKET_ROWS] for k in range(0, len(order), BUCKET_ROWS)]
    return [Bucket(vectors[c], lengths[c], ids[c], labels[c]) for c in cuts]


def _search(find: Callable[[Anchor, list[Bucket]], list[tuple]]):
    """Each group's rows come first; the anchors after them are answered batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, buckets = None, [], []
        for batch in batches:
            groups, asks = batch.column("group").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]) | (asks[1:] != asks[:-1])])
            for a, b in zip(cuts, np.r_[cuts[1:], len(groups)]):
                some = batch.slice(a, b - a)
                if groups[a] != group:
                    group, rows, buckets = groups[a], [], []
                if not asks[a]:
                    rows.append(some)
                    continue
                if rows:
                    buckets, rows = buckets_of(rows), []
                if buckets:
                    dims = buckets[0].vectors.shape[1]
                    found = [r for x in some.to_pylist() for r in find(Anchor(x, dims), buckets)]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], f.type) for k, f in enumerate(_FOUND)], schema=_FOUND)
    return run


_ROW = ("row", "id", "label", "vector", "length")


def search(rows: DataFrame, groups: int, anchors: DataFrame, find: Callable[[Anchor, list[Bucket]], list[tuple]]) -> DataFrame:
    """What is found for each anchor in each group. `anchors` has `positives` besides the columns of a row."""
    kind = anchors.schema["positives"].dataType.simpleString()
    held = rows.select("group", F.lit(False).alias("asks"), *_ROW, F.lit(None).cast(kind).alias("positives"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(True).alias("asks"), *_ROW, "positives")
    dealt = held.union(asked).repartitionById(groups, F.col("group")).sortWithinPartitions("group", "asks")
    return dealt.mapInArrow(_search(find), FOUND)


def first_of(found: DataFrame, keys: list[str], size: int, place: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn(place, F.row_number().over(order)).filter(F.col(place) <= size)


def mine(embeddings: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95), scale: int = 256,
         vector: str = "embedding", label: str = "label", identifier: str = "vec_id") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor row and each of its first positives, the first
    rows of another label whose score is within `percent` of the positive's."""
    # Batches are of few rows, since vectors are long.
    embeddings.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    rows, groups = index(usable(embeddings, anchors, scale, vector, label, identifier))
    asked = rows.filter("is_anchor")
    shape = "array<struct<place: int, id: bigint, score: bigint>>"
    near = search(rows, groups, asked.withColumn("positives", F.lit(None).cast(shape)), lambda a, b: positives_of(a, b, positives))
    best = (first_of(near, ["row"], positives, "place").groupBy("row")
            .agg(F.collect_list(F.struct("place", "id", "score")).cast(shape).alias("positives")))
    far = search(rows, groups, asked.join(best, "row"), lambda a, b: negatives_of(a, b, negatives, percent))
    return first_of(far, ["row", "place"], negatives, "rank").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
