"""Removal of passages that stand in an earlier document, found by a count-min prefilter and exact grouping.

A window is so many consecutive words. First pass: every task puts the windows of its documents into a count-min sketch, once
for each document. A window is entered by its anchor, the least hash of the shorter runs of words in it: equal windows have
equal anchors, and neighbouring windows mostly the same one, so that the sketch has a few times fewer entries than windows
and its estimate is never below a window's count. The sketch is cut into parts by the anchor's hash. Tasks send each part
their own sparse sketch of it; the part adds these up, and answers the documents of whose anchors it counts two or more. No
part is sent to all, so the sketch grows with the input, a cell for every eight bytes in each of `DEPTH` rows, and estimates as
well at any size. An anchor that several documents of a task share is answered there, and goes to its part once for the task.

Second pass: only windows with an answered anchor are grouped exactly, by 96 bits of hash, for their first document. Within a
task, the least document of a window settles the others there, so that a passage of a third of all documents makes one row for
each task. Third pass: covered words are removed. Both join the texts by the same key, for which they are shuffled once.

Defined cases: a null text has no words; a text with fewer words than a window is kept; rows without an id neither remove nor lose
words; rows with the same id do not remove each other's words; an empty table gives an empty result; extra columns are not
read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ddlscope.llm.rules import covering
from ddlscope.llm.texts import EXACT, Block, blocks, bound_batches, mix, ranges, returning

#: Rows of the sketch, and the least bits that number the cells of a part.
DEPTH, SLICE_BITS = 2, 16
ANCHOR = 8
#: Entries that a task gathers before it passes them on.
GATHER = 1_000_000
FIRST = np.random.default_rng(41).integers(1, 2**63, 64, np.uint64) | np.uint64(1)
SECOND = np.random.default_rng(42).integers(1, 2**63, 64, np.uint64) | np.uint64(1)


def runs(words: np.ndarray, begins: np.ndarray, size: int, by: np.ndarray) -> np.ndarray:
    out = np.zeros(len(begins), np.uint64)
    for k in range(size):
        out += words[begins + k] * by[k % 64] + np.uint64(k // 64)
    return mix(out)


def anchors(block: Block, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and anchor of every window."""
    short = min(ANCHOR, size)
    if len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    parts = runs(words, np.arange(len(words) - short + 1), short, FIRST)
    count = len(words) - size + 1
    least = parts[:count].copy()
    for k in range(1, size - short + 1):
        np.minimum(least, parts[k:k + count], out=least)
    begins = np.flatnonzero(block.row[:count] == block.row[size - 1:])
    return begins, least[begins]


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(hashes, 11 + row) >> np.uint64(64 - bits)).astype(np.int64)


#: An anchor (48 bits of it) of the row of a document that has this key; and one that several rows of a task have.
ENTRY = np.dtype([("high", "<u4"), ("low", "<u2"), ("key", "<i8")])
SHARED = np.dtype([("high", "<u4"), ("low", "<u2")])
ONCE, TWICE, ANSWER = range(3)


def of_part(hashes: np.ndarray, salt: int, groups: int) -> np.ndarray:
    return (mix(hashes, salt) % np.uint64(groups)).astype(np.int64)


def written(kind: np.dtype, hashes: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
    rows = np.zeros(len(hashes), kind)
    rows["high"], rows["low"] = hashes >> np.uint64(16), hashes & np.uint64(0xFFFF)
    if keys is not None:
        rows["key"] = keys
    return rows


def hashes_of(rows: np.ndarray) -> np.ndarray:
    return rows["high"].astype(np.uint64) << np.uint64(16) | rows["low"]


def answers(found: np.ndarray, groups: int) -> tuple[list[int], list[bytes]]:
    """The entries of the documents of each part, written together."""
    found = found[np.lexsort((found["low"], found["high"], found["key"]))]
    return dealt(found, of_part(found["key"].astype(np.uint64), 22, groups), squeeze)


def asked(documents: DataFrame, size: int, bits: int, groups: int) -> DataFrame:
    """`of_key` and its `anchors`, those that the sketch estimates to be in two documents or more, for the keys that have any."""
    def emit(found: list[np.ndarray], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes, key = np.concatenate(found), np.concatenate(keys)
        order = np.lexsort((key, hashes))
        hashes, key = hashes[order], key[order]
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (key[1:] != key[:-1])]  # a repeated row counts once
        hashes, key = hashes[new], key[new]
        same = np.r_[False, hashes[1:] == hashes[:-1], False]
        several = same[1:] | same[:-1]
        shared = hashes[several & ~same[:-1]]
        batches = [(ONCE, dealt(written(ENTRY, hashes[~several], key[~several]), of_part(hashes[~several], 21, groups), squeeze)),
                   (TWICE, dealt(written(SHARED, shared), of_part(shared, 21, groups), squeeze)),
                   (ANSWER, answers(written(ENTRY, hashes[several], key[several]), groups))]
        for kind, (parts, data) in batches:
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([kind] * len(parts), pa.int8()), pa.array(data, pa.binary())],
                                             names=["part", "kind", "data"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, keys, held = [], [], 0
        for batch in batches:
            for block in blocks(batch):
                begins, hashes = anchors(block, block.words(EXACT), size)
                rows, hashes = block.row[begins], hashes >> np.uint64(16)
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                if new.any():
                    found.append(hashes[new])
                    keys.append(block.rows.column("key").to_numpy()[rows[new]])
                    held += len(found[-1])
                if held >= GATHER:
                    yield from emit(found, keys)
                    found, keys, held = [], [], 0
        if found:
            yield from emit(found, keys)

    def estimate(table: pa.Table) -> pa.Table:
        """What came as an answer goes on; the sketches of a part are added up, and answer its entries."""
        kinds, data = table.column("kind").to_numpy(), table.column("data").to_pylist()
        once = np.concatenate([np.zeros(0, ENTRY), *(expand(x, ENTRY) for x, k in zip(data, kinds) if k == ONCE)])
        twice = np.concatenate([np.zeros(0, SHARED), *(expand(x, SHARED) for x, k in zip(data, kinds) if k == TWICE)])
        hashes, several = hashes_of(once), hashes_of(twice)
        repeated = np.ones(len(once), bool)
        for row in range(DEPTH):
            at = cells(hashes, row, bits)
            counts = np.bincount(at, minlength=1 << bits)
            counts += 2 * np.bincount(cells(several, row, bits), minlength=1 << bits)
            repeated &= counts[at] > 1
        part, new = answers(once[repeated], groups)
        new = pa.table({"part": pa.array(part, pa.int32()), "data": pa.array(new, pa.binary())})
        return pa.concat_tables([table.filter(pa.array(kinds == ANSWER)).select(["part", "data"]), new])

    def by_key(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.zeros(0, ENTRY), *(expand(x, ENTRY) for x in table.column("data").to_pylist())])
        hashes = hashes_of(rows)
        order = np.lexsort((hashes, rows["key"]))
        hashes, key = hashes[order], rows["key"][order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (hashes[1:] != hashes[:-1])
        hashes, key = hashes[new], key[new]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        lists = [hashes[a:b].tobytes() for a, b in zip(heads, np.r_[heads[1:], len(key)])]
        return pa.table({"of_key": pa.array(key[heads], pa.int64()), "anchors": pa.array(lists, pa.binary())})

    sent = documents.filter("doc_id IS NOT NULL").mapInArrow(returning(gather), "part int, kind tinyint, data binary")
    answered = sent.groupBy("part").applyInArrow(estimate, "part int, data binary")
    return answered.groupBy("part").applyInArrow(by_key, "of_key long, anchors binary")


def among(block: Block, begins: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows have an anchor that their row was answered."""
    lists = block.rows.column("anchors").to_pylist()
    sizes = [len(x) // 8 if x else 0 for x in lists]
    known = np.frombuffer(b"".join(x for x in lists if x), np.uint64)
    of_row = lambda values, row: mix(values + mix(row.astype(np.uint64), 23))
    return np.isin(of_row(hashes >> np.uint64(16), block.row[begins]), of_row(known, np.repeat(np.arange(len(lists)), sizes)))


#: A window that still is to be settled, and a place in a document whose window has an earlier one.
OPEN = np.dtype([("a", "<u8"), ("b", "<u4"), ("id", "<i8"), ("key", "<i8"), ("at", "<i4")])


def later(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in order of window and id, and which have the same window in a document with a smaller id."""
    rows = rows[np.lexsort((rows["at"], rows["id"], rows["b"], rows["a"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    heads = np.flatnonzero(new)
    least = np.repeat(rows["id"][heads], np.diff(np.r_[heads, len(rows)]))
    return rows, rows["id"] > least


def pack(rows: np.ndarray) -> bytes:
    """Column by column, documents once, places as steps: what compresses, compresses."""
    rows = rows[np.lexsort((rows["at"], rows["key"], rows["id"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["id"][1:] != rows["id"][:-1]) | (rows["key"][1:] != rows["key"][:-1])
    heads = np.flatnonzero(new).astype("<i4")
    steps = np.diff(rows["at"], prepend=np.int32(0)).astype("<i4")
    columns = (rows["a"], rows["b"], rows["id"][heads], rows["key"][heads], heads, steps)
    raw = np.array([len(rows), len(heads)], "<i8").tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n, heads_n = np.frombuffer(raw, "<i8", 2)
    rows, at = np.zeros(n, OPEN), 16

    def column(kind: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(raw, kind, count, at)
        at += values.nbytes
        return values
    rows["a"], rows["b"] = column("<u8", n), column("<u4", n)
    ids, keys, heads = column("<i8", heads_n), column("<i8", heads_n), column("<i4", heads_n)
    sizes = np.diff(np.r_[heads, n])
    rows["id"], rows["key"] = np.repeat(ids, sizes), np.repeat(keys, sizes)
    rows["at"] = np.cumsum(column("<i4", n))
    return rows


#: Windows that begin at `low` up to before `high` in a document and stand in an earlier one.
RUN = np.dtype([("id", "<i8"), ("key", "<i8"), ("low", "<i4"), ("high", "<i4")])


def as_runs(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows["at"], rows["key"], rows["id"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["id"][1:] != rows["id"][:-1]) | (rows["key"][1:] != rows["key"][:-1]) | (rows["at"][1:] > rows["at"][:-1] + 1)
    first = np.flatnonzero(new)
    out = np.zeros(len(first), RUN)
    if len(first):
        out["id"], out["key"], out["low"] = rows["id"][first], rows["key"][first], rows["at"][first]
        out["high"] = rows["at"][np.r_[first[1:], len(rows)] - 1] + 1
    return out


def squeeze(rows: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)
    return len(rows).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(data: bytes, kind: np.dtype) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw, at = pa.decompress(data[8:], n * kind.itemsize, codec="zstd", asbytes=True), 0
    rows = np.zeros(n, kind)
    for name in kind.names:
        rows[name] = np.frombuffer(raw, kind[name], n, at)
        at += n * kind[name].itemsize
    return rows


def dealt(items: np.ndarray, part: np.ndarray, write) -> tuple[list[int], list[bytes]]:
    """The items of each part, written together."""
    order = np.argsort(part, kind="stable")
    items, part = items[order], part[order]
    heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    return part[heads].tolist(), [write(items[a:b]) for a, b in zip(heads, np.r_[heads[1:], len(part)])]


def by_document(runs: np.ndarray, groups: int) -> tuple[list[int], list[bytes]]:
    """The runs of the documents of each part, written together: some rows for a task, not for a document."""
    return dealt(runs, of_part(runs["key"].astype(np.uint64), 22, groups), squeeze)


def places(documents: DataFrame, asked_of: DataFrame, size: int, groups: int) -> DataFrame:
    """of_key and the runs of the first words of windows that an earlier document has, one row for a key."""
    def emit(found: list[np.ndarray], anchor: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows, part = np.concatenate(found), of_part(np.concatenate(anchor), 21, groups)
        order = np.lexsort((rows["at"], rows["id"], rows["b"], rows["a"]))
        rows, part = rows[order], part[order]
        _, settled = later(rows)
        done, runs_ = by_document(as_runs(rows[settled]), groups)
        left, open_ = dealt(rows[~settled], part[~settled], pack)
        yield pa.RecordBatch.from_arrays([pa.array(done + left, pa.int32()), pa.array([True] * len(done) + [False] * len(left)),
                                          pa.array(runs_ + open_, pa.binary())], names=["part", "settled", "data"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, anchor, held = [], [], 0
        for batch in batches:
            for block in blocks(batch):
                words = block.words(EXACT)
                begins, hashes = anchors(block, words, size)
                hit = among(block, begins, hashes)
                begins, hashes = begins[hit], hashes[hit]
                rows = np.zeros(len(begins), OPEN)
                rows["a"] = runs(words, begins, size, FIRST)
                rows["b"] = runs(words, begins, size, SECOND) >> np.uint64(32)
                of = block.row[begins]
                rows["id"] = block.rows.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)[of]
                rows["key"] = block.rows.column("key").to_numpy()[of]
                rows["at"] = begins - block.first[of]
                found.append(rows)
                anchor.append(hashes)
                held += len(rows)
                if held >= GATHER:
                    yield from emit(found, anchor)
                    found, anchor, held = [], [], 0
        if held:
            yield from emit(found, anchor)

    def settle(table: pa.Table) -> pa.Table:
        """Runs of documents, dealt by document; those that came settled go on."""
        done = table.column("settled").to_numpy()
        open_ = [unpack(x) for x, y in zip(table.column("data").to_pylist(), done) if not y]
        rows, is_later = later(np.concatenate(open_) if open_ else np.zeros(0, OPEN))
        part, data = by_document(as_runs(rows[is_later]), groups)
        new = pa.table({"part": pa.array(part, pa.int32()), "data": pa.array(data, pa.binary())})
        return pa.concat_tables([table.filter(pa.array(done)).select(["part", "data"]), new])

    def collect(table: pa.Table) -> pa.Table:
        runs_ = np.concatenate([expand(x, RUN) for x in table.column("data").to_pylist()])
        runs_ = runs_[np.lexsort((runs_["low"], runs_["id"], runs_["key"]))]
        heads = np.flatnonzero(np.r_[True, runs_["key"][1:] != runs_["key"][:-1]])
        triples = np.column_stack([runs_["id"], runs_["low"], runs_["high"]])
        found = [triples[a:b].tobytes() for a, b in zip(heads, np.r_[heads[1:], len(runs_)])]
        return pa.table({"of_key": pa.array(runs_["key"][heads]), "runs": pa.array(found, pa.binary())})

    joined = documents.join(asked_of, F.col("key") == F.col("of_key"))
    spread = joined.select("doc_id", "key", "text", "anchors").mapInArrow(returning(gather), "part int, settled boolean, data binary")
    settled = spread.groupBy("part").applyInArrow(settle, "part int, data binary")
    return settled.groupBy("part").applyInArrow(collect, "of_key long, runs binary")


def kept(documents: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """Each document without the covered words."""
    def step(block: Block) -> pa.RecordBatch:
        covered = np.zeros(len(block.bounds[0]), bool)
        begins = []
        for i, (parts, of) in enumerate(zip(block.rows.column("runs").to_pylist(), block.rows.column("doc_id").cast(pa.int64()).to_pylist())):
            if parts and of is not None:
                triples = np.frombuffer(parts, "<i8").reshape(-1, 3)
                triples = triples[triples[:, 0] == of]  # another document may have the key
                begins.append(block.first[i] + ranges(triples[:, 1], triples[:, 2] - triples[:, 1]))
        if begins:
            covered = covering(np.concatenate(begins), size, len(covered))
        starts, ends = (b[~covered] for b in block.bounds)
        data = np.r_[block.data, np.uint8(32)]
        sizes = ends - starts + 1
        index = ranges(starts, sizes)
        if len(sizes):
            index[np.cumsum(sizes) - 1] = len(block.data)  # one space after each word
        text = data[index].tobytes()
        stay = np.bincount(block.row[~covered], minlength=len(block))
        at = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(stay)]].tolist()
        out = [text[a:max(a, b - 1)] for a, b in zip(at[:-1], at[1:])]
        return pa.RecordBatch.from_arrays([block.rows.column("doc_id"), pa.array(block.n_words, pa.int64()), pa.array(block.n_words - stay, pa.int64()),
                                           pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                yield step(block)

    kind = documents.schema["doc_id"].dataType.simpleString()
    joined = documents.join(found, F.col("key") == F.col("of_key"), "left")
    return joined.select("doc_id", "text", "runs").mapInArrow(returning(run), f"doc_id {kind}, n_words long, n_removed long, text string")


def without_repeats(documents: DataFrame, size: int = 13, most_bits: int = 29) -> DataFrame:
    """doc_id, n_words, n_removed and the text that is left, words joined by one space, for every row (doc_id, text). The sketch
    has a part for each 8 MB of text, so `most_bits`, the most bits that number the cells of one, bounds memory and not the sketch."""
    bound_batches(documents.sparkSession)
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(32, volume >> 23)
    bits = min(most_bits, max(SLICE_BITS, (volume // groups // 8).bit_length()))
    return kept(rows, places(rows, asked(rows, size, bits, groups), size, groups), size)
