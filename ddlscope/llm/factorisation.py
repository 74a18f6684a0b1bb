"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

The score of a text is the logistic function of w0 + sum(w_i x_i) + sum over pairs of <v_i, v_j> x_i x_j. The pairs are never
formed: their sum is half of sum over factors of (sum v_if x_i)**2 - sum (v_if x_i)**2, linear in the features. Features are
the distinct lower-case words, hashed, with equal weights and unit length; shares and lengths that describe the structure of
the text, standardised; and the stated number of characters against the real one. Language, source, id and labels are none.

The model is fitted on the driver on a bounded sample (at most `ROWS` rows of each label, each with all its features; a model of
fixed size), whatever the data. A text of the sample reaches the driver in `PACKED` bytes at most. Every text is scored in full.

Defined cases: a null or empty text has the features of no words; without labelled rows every score is 0.5; null ids are
not held out; repeated rows are scored each; extra columns are not read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ddlscope.llm import rules
from ddlscope.llm.texts import EXACT, FOLDED, NEWLINE, PUNCTUATION, Block, map_blocks, marks
from ddlscope.llm.training import sample

BITS, FACTORS = 15, 8
#: Bound of the sample: rows of each label.
ROWS = 3000
#: The bytes of a set of buckets as one bit for each.
PACKED = (1 << BITS) // 8
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.08, 1e-4
UPPER, DIGIT = marks(bytes(range(65, 91))), marks(bytes(range(48, 58)))
LETTER = marks(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
STATISTICS = 14


def statistics(block: Block, sums: np.ndarray, words: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """The structure of each text in numbers."""
    size, n = np.diff(block.at), block.n_words
    size1, n1 = np.maximum(size, 1), np.maximum(n, 1)
    lengths = (block.bounds[1] - block.bounds[0]).astype(float)
    lines = block.counted(NEWLINE) + 1
    shouted = block.counted(marks(b"!"))
    stated = block.rows.column("n_chars").cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False) if "n_chars" in block.rows.schema.names else size
    stated = np.clip(np.nan_to_num(stated), 0, None)
    ends_word = block.bounds[1] - 1
    tail = rules.per_row(block, block.row[PUNCTUATION[block.data[ends_word]]]) if len(words) else np.zeros(len(block))
    lone = rules.per_row(block, block.row[lengths == 1])
    columns = [
        np.log1p(n), np.log1p(stated), rules.symbols(block) / size1, block.counted(UPPER) / np.maximum(block.counted(LETTER), 1),
        block.counted(DIGIT) / size1, block.counted(PUNCTUATION) / size1, shouted / n1, rules.duplicate_lines(block, sums) / lines,
        rules.repeat_words(block, words) / n1, rules.per_row(block, block.row, lengths) / n1, distinct / n1, lines / n1,
        tail / n1, lone / n1]
    return np.column_stack(columns).astype(np.float64)


def features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of the distinct words of each text, and the statistics."""
    sums = block.sums(EXACT)
    exact = block.pieces(*block.bounds, EXACT, sums)
    buckets = (block.words(FOLDED) >> np.uint64(64 - BITS)).astype(np.int64)
    keys = np.unique(block.row << BITS | buckets)
    rows = keys >> BITS
    return rows, keys & (1 << BITS) - 1, statistics(block, sums, exact, np.bincount(rows, minlength=len(block)))


def packed(buckets: np.ndarray) -> bytes:
    """Distinct buckets as numbers of two bytes, or as one bit for each bucket where that is no longer."""
    if 2 * len(buckets) < PACKED:
        return np.sort(buckets).astype("<u2").tobytes()
    held = np.zeros(1 << BITS, bool)
    held[buckets] = True
    return np.packbits(held).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < PACKED:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


@dataclass
class Machine:
    """Weights and factors of the buckets, then of the statistics; the statistics' mean and deviation."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.deviation, -5, 5) / np.sqrt(STATISTICS)

    def sums(self, rows: np.ndarray, buckets: np.ndarray, dense: np.ndarray):
        """For each text: the linear part, and for each factor the sum of v x and of (v x)**2; the value of each word."""
        texts = len(dense)
        counts = np.bincount(rows, minlength=texts)
        value = 1 / np.sqrt(np.maximum(counts, 1))[rows]
        ends = np.r_[0, np.cumsum(counts)]
        vx = self.factors[buckets] * value[:, None]
        total = lambda x: np.diff(np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, axis=0, dtype=np.float64)])[ends], axis=0)
        v, w = self.factors[1 << BITS:], self.weights[1 << BITS:]
        linear = self.bias + np.bincount(rows, self.weights[buckets] * value, texts) + dense @ w
        return linear, total(vx) + dense @ v, total(vx * vx) + (dense ** 2) @ (v ** 2), value

    def score(self, rows: np.ndarray, buckets: np.ndarray, stats: np.ndarray) -> np.ndarray:
        linear, once, squares, _ = self.sums(rows, buckets, self.dense(stats))
        return 1 / (1 + np.exp(-np.clip(linear + ((once ** 2) - squares).sum(axis=1) / 2, -30, 30)))


def untrained() -> Machine:
    size = (1 << BITS) + STATISTICS
    return Machine(0.0, np.zeros(size), np.zeros((size, FACTORS)), np.zeros(STATISTICS), np.ones(STATISTICS))


def fit(texts: Sequence[bytes], stats: np.ndarray, labels: np.ndarray, share: float) -> Machine:
    """Adagrad on logistic loss. `texts` are the packed buckets of each text, which are unpacked a batch at a time; `share` is that of label 1 among all labelled rows, so that scores are probabilities there
    though the sample holds as many of each label."""
    model = untrained()
    if not len(labels):
        return model
    rng = np.random.default_rng(7)
    model.mean, model.deviation = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
    model.factors = rng.normal(0, 0.05, model.factors.shape)
    dense, base = model.dense(stats), 1 << BITS
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    gw, gv, gb = np.full(model.weights.shape, 1e-6), np.full(model.factors.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for low in range(0, len(order), BATCH):
            some = order[low:low + BATCH]
            words = [unpacked(texts[i]) for i in some]
            rows, buckets, x = np.repeat(np.arange(len(some)), [len(w) for w in words]), np.concatenate(words), dense[some]
            linear, once, squares, value = model.sums(rows, buckets, x)
            p = 1 / (1 + np.exp(-np.clip(linear + (once ** 2 - squares).sum(axis=1) / 2, -30, 30)))
            error = (p - labels[some]) * weight[some] / len(some)
            slope = error[rows] * value
            touched, which = np.unique(buckets, return_inverse=True)
            dw = np.r_[np.bincount(which, slope, len(touched)), error @ x]
            dv = np.column_stack([np.bincount(which, slope * (once[rows, f] - model.factors[buckets, f] * value), len(touched)) for f in range(FACTORS)])
            v = model.factors[base:]
            dv = np.vstack([dv, (error[:, None] * x).T @ once - ((error[:, None] * x ** 2).sum(axis=0))[:, None] * v])
            at = np.r_[touched, base + np.arange(STATISTICS)]
            dw, dv = dw + DECAY * model.weights[at], dv + DECAY * model.factors[at]
            gw[at] += dw ** 2
            gv[at] += dv ** 2
            gb += error.sum() ** 2
            model.weights[at] -= RATE * dw / np.sqrt(gw[at])
            model.factors[at] -= RATE * dv / np.sqrt(gv[at])
            model.bias -= RATE * error.sum() / np.sqrt(gb)
    return model


def train(documents: DataFrame, labels: DataFrame, rows: int = ROWS) -> Machine:
    from pyspark.sql import functions as F

    from ddlscope.llm.training import held_out

    def step(block: Block) -> pa.RecordBatch:
        row, buckets, stats = features(block)
        ends = np.searchsorted(row, np.arange(len(block) + 1))
        words = [packed(buckets[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return pa.RecordBatch.from_arrays([block.rows.column("label"), pa.array(words, pa.binary()),
                                           pa.array([s.tobytes() for s in stats], pa.binary())], names=["label", "words", "stats"])

    some = sample(documents.select(*columns(documents)), labels, "quality", rows)
    got = map_blocks(some, step, "label int, words binary, stats binary").toPandas()
    known = labels.filter(F.col("quality").isNotNull() & ~held_out()).agg(F.avg(F.col("quality").cast("double"))).first()[0]
    order = sorted(range(len(got)), key=lambda i: (got["words"][i], got["stats"][i], got["label"][i]))  # not that of the tasks
    texts = [got["words"][i] for i in order]
    stats = np.array([np.frombuffer(got["stats"][i]) for i in order]).reshape(-1, STATISTICS)
    return fit(texts, stats, got["label"].to_numpy(np.float64)[order], known or 0.5)


def columns(documents: DataFrame) -> list[str]:
    return ["doc_id", "text", *(["n_chars"] if "n_chars" in documents.columns else [])]


def score(documents: DataFrame, model: Machine) -> DataFrame:
    """doc_id and score of each row."""
    kept = documents.select(*columns(documents))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def step(block: Block) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([block.rows.column("doc_id"), pa.array(shared.value.score(*features(block)))], names=["doc_id", "score"])
    return map_blocks(kept, step, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, score double")


def accepted(documents: DataFrame, model: Machine, least: float = 0.3) -> DataFrame:
    """The rows, with all their columns, that score that much or more."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def step(block: Block) -> pa.RecordBatch:
        return block.rows.filter(pa.array(shared.value.score(*features(block)) >= least))
    return map_blocks(documents, step, documents.schema)
