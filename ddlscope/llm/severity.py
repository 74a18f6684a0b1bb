"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade > k) is the logistic function of x.w - c_k, with one weight vector for all grades and cut points c_0 <= c_1 <= ...;
the expected severity is the sum of these probabilities. Features are the presence of tokens (runs of letters and digits,
in lower case) and of their beginnings of 4 to 8 bytes, hashed. The weights are sparse: only features that set the toxic texts of
the sample apart get one.

Labels say only whether a text is toxic. A toxic text of the sample gets its grade from a model that has not seen it: the sample
is cut into `FOLDS`, each is scored by a logistic regression on the labels of the others, and the scores of the toxic texts are
cut into grades at the shares of `STEPS`. So a grade says how far a text's words are toxic by the labels of other texts; with graded
labels pass those instead (`fit`).

The model is fitted on a bounded sample (at most `ROWS` rows of each label, each with all its features). Spark counts in how many
texts of the sample a feature stands, and picks at most `FEATURES` of them; only which of these a text holds reaches the driver,
where the weights are fitted. Every text is scored in full.

Defined cases: a null or empty text has no features and the severity of the cut points alone; without toxic rows in the sample
every severity is 0; repeated rows are scored each; null ids are scored; extra columns are not read."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ddlscope.llm.texts import FOLDED, PUNCTUATION, SPACE, Block, map_blocks
from ddlscope.llm.training import sample
from ddlscope.session import scratch_path

BITS = 24
BEGINNINGS = (4, 5, 6, 7, 8)
ROWS, FEATURES = 4000, 512
#: A marker occurs in so many toxic texts of the sample, and so much more often there (logarithm).
SUPPORT, ODDS = 5, 2.5
#: Grades 1, 2 and 3 of a toxic text: above so large a share of the toxic texts.
STEPS = (0, 1 / 3, 2 / 3)
FOLDS = 5


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each feature of each token, repeated as the token is."""
    starts, ends = block.between(SPACE | PUNCTUATION)
    rows, sums = block.row_of(starts), block.sums(FOLDED)
    out = [(rows, block.pieces(starts, ends, FOLDED, sums))]
    for size in BEGINNINGS:
        long = np.flatnonzero(ends - starts > size)
        # Told apart from whole tokens by one bit, so that a beginning is not the token of the same letters.
        out.append((rows[long], block.pieces(starts[long], starts[long] + size, FOLDED, sums) ^ np.uint64(1 << 63)))
    return np.concatenate([r for r, _ in out]), (np.concatenate([h for _, h in out]) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """Buckets in order with their weights, and the cut points."""

    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.full(len(STEPS), np.inf))

    def present(self, rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and index of the model's features, once for each text."""
        if not len(self.buckets):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        table = np.zeros(1 << BITS >> 3, np.uint8)
        np.bitwise_or.at(table, self.buckets >> 3, (1 << (self.buckets & 7)).astype(np.uint8))
        hit = table[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1 == 1
        keys = np.unique(rows[hit] * len(self.buckets) + np.searchsorted(self.buckets, buckets[hit]))
        return keys // len(self.buckets), keys % len(self.buckets)

    def above(self, rows: np.ndarray, index: np.ndarray, texts: int) -> np.ndarray:
        """P(grade > k) for each text and cut."""
        x = np.bincount(rows, self.weights[index], texts)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.cuts - x[:, None]))


def markers(rows: DataFrame) -> np.ndarray:
    """The buckets that set toxic texts apart among rows with `label` and `text`, the most telling first, bounded in number. Each
    block counts its own texts before the shuffle."""
    def step(block: Block) -> pa.RecordBatch:
        row, buckets = features(block)
        keys = np.unique(row << BITS | buckets)
        toxic = block.rows.column("label").to_numpy(zero_copy_only=False).astype(bool)[keys >> BITS]
        found, which = np.unique(keys & (1 << BITS) - 1, return_inverse=True)
        n1 = np.bincount(which, toxic, len(found)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(n1), pa.array(np.bincount(which, minlength=len(found)) - n1)],
                                          names=["bucket", "n1", "n0"])

    toxic, clean = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    share = lambda n, of: F.log((F.col(n) + 0.5) / (of + 1))
    odds = share("n1", toxic) - share("n0", clean)
    best = (map_blocks(rows, step, "bucket int, n1 long, n0 long").groupBy("bucket").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
            .withColumn("odds", odds).filter((F.col("n1") >= SUPPORT) & (F.col("odds") >= ODDS))
            .orderBy(F.desc(F.col("odds") * F.col("n1")), "bucket").limit(FEATURES))
    return np.sort(np.array([r["bucket"] for r in best.collect()], np.int64))


def apart(cuts: np.ndarray, gap: float) -> np.ndarray:
    """The cut points in order, each so far above the last at least: between equal ones a grade would have no probability."""
    steps = gap * np.arange(len(cuts))
    return np.maximum.accumulate(cuts - steps) + steps


def fit(present: list[np.ndarray], grades: np.ndarray, buckets: np.ndarray, rounds: int = 400, rate: float = 0.3, ridge: float = 1e-4,
        cuts_n: int = len(STEPS)) -> Model:
    """Weights and cut points by gradient steps on the likelihood of the grades; `present` has the features of each text."""
    n = len(grades)
    rows = np.repeat(np.arange(n), [len(p) for p in present])
    index = np.concatenate(present) if n else np.zeros(0, np.int64)
    above = (grades[:, None] > np.arange(cuts_n)).astype(float)
    share = np.clip(above.mean(axis=0), 0.5 / n, 1 - 0.5 / n)
    model = Model(buckets, np.zeros(len(buckets)), apart(np.sort(np.log(1 / share - 1)), 1.0))
    momentum = [np.zeros(len(buckets)), np.zeros(cuts_n)]
    squares = [np.full(len(buckets), 1e-8), np.full(cuts_n, 1e-8)]
    for step in range(1, rounds + 1):
        # P(y = g) = S_{g-1} - S_g with S = P(y > k): the derivative of its logarithm by each S.
        s = np.column_stack([np.ones(n), model.above(rows, index, n), np.zeros(n)])
        p = np.maximum(s[np.arange(n), grades] - s[np.arange(n), grades + 1], 1e-4)
        slope = s * (1 - s)
        by_high, by_low = slope[np.arange(n), grades] / p, slope[np.arange(n), grades + 1] / p
        to_x = (by_high - by_low) / n
        to_c = np.array([(-by_high[grades == k + 1].sum() + by_low[grades == k].sum()) / n for k in range(cuts_n)])
        for i, (value, gradient) in enumerate(((model.weights, np.bincount(index, to_x[rows], len(buckets)) - ridge * model.weights), (model.cuts, to_c))):
            momentum[i] = 0.9 * momentum[i] + 0.1 * gradient
            squares[i] = 0.99 * squares[i] + 0.01 * gradient ** 2
            value += rate / step ** 0.25 * (momentum[i] / (1 - 0.9 ** step)) / np.sqrt(squares[i] / (1 - 0.99 ** step) + 1e-12)
        model.cuts = apart(model.cuts, 0.05)
    return model


def grades_of(present: list[np.ndarray], toxic: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Grades of the texts of a sample by their label, and of toxic ones by the score that the other folds give them. A score has the
    scale of its fold, so a text's place among the toxic ones of its fold counts; equal scores have the lower place."""
    fold, grades = np.arange(len(toxic)) % FOLDS, np.zeros(len(toxic), np.int64)
    for k in range(FOLDS):
        others, mine = np.flatnonzero(fold != k), np.flatnonzero((fold == k) & toxic)
        if len(mine):
            model = fit([present[i] for i in others], toxic[others].astype(np.int64), buckets, rounds=150, cuts_n=1)
            scores = np.array([model.weights[present[i]].sum() for i in mine])
            grades[mine] = 1 + np.searchsorted(np.quantile(scores, STEPS[1:]), scores, "left")
    return grades


def train(documents: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """The sample is written to the shared folder, since it is read more than once."""
    spark, path = documents.sparkSession, scratch_path(documents.sparkSession, "sample")
    sample(documents.select("doc_id", "text"), labels, "toxic", rows).select("label", "text").write.parquet(path)
    some = spark.read.parquet(path)
    buckets = markers(some)
    known = Model(buckets, np.zeros(len(buckets)))

    def step(block: Block) -> pa.RecordBatch:
        row, index = known.present(*features(block))
        ends = np.searchsorted(row, np.arange(len(block) + 1))
        found = [index[a:b].astype(np.int32).tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return pa.RecordBatch.from_arrays([block.rows.column("label"), pa.array(found, pa.binary())], names=["label", "found"])

    got = map_blocks(some, step, "label int, found binary").toPandas()
    order = sorted(range(len(got)), key=lambda i: (got["found"][i], got["label"][i]))
    toxic = got["label"].to_numpy(bool)[order]
    if not toxic.any():
        return Model()
    present = [np.frombuffer(got["found"][i], np.int32).astype(np.int64) for i in order]
    return fit(present, grades_of(present, toxic, buckets), buckets)


def grade(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, P(grade > k) for each k, expected severity, the most likely grade, and whether the text is toxic."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def step(block: Block) -> pa.RecordBatch:
        above = shared.value.above(*shared.value.present(*features(block)), len(block))
        s = np.column_stack([np.ones(len(block)), above, np.zeros(len(block))])
        likely = np.argmax(s[:, :-1] - s[:, 1:], axis=1).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [block.rows.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(likely), pa.array(above[:, 0] >= least),
             *(pa.array(above[:, k]) for k in range(above.shape[1]))],
            names=["doc_id", "severity", "grade", "toxic", *(f"p_above_{k}" for k in range(above.shape[1]))])
    kind = documents.schema["doc_id"].dataType.simpleString()
    more = ", ".join(f"p_above_{k} double" for k in range(len(STEPS)))
    return map_blocks(documents.select("doc_id", "text"), step, f"doc_id {kind}, severity double, grade int, toxic boolean, {more}")
