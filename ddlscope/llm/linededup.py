"""Line dedup: lines that stand in several documents stay in one of them.

A line's key is the line without white space (space and U+0009 to U+000D) at both ends and with A to Z in lower case. Keys of
at least `least_chars` code points that are found in at least `least_documents` documents lose all of their lines but those in
the largest doc_id that holds them. All other lines stay as they are.

Each task hashes the keys of its texts to 128 bits and hands on one row for each text and key, with the places of its lines;
no text travels. These rows are range-partitioned by hash, document (largest first) and text, and sorted so: a task streams
over them and meets the documents of a key one after the other. The first keeps the lines; from the document on that
makes them enough, all others lose theirs, those between included. A frequent key may reach over many partitions. So of the
first and the last key of a partition, what its own rows leave open is put aside, together with a row of the largest
documents seen; these rows, two for each partition, settle it. What comes back for each text that loses lines is a bitmap with
a bit for each line, compressed; the text meets it once.

Defined cases: a null or empty text is one empty line; a document is a doc_id, so rows that share one count as one document and
rows alike in doc_id and text get the same bitmap; rows whose doc_id is null (or no whole number) take no part and keep all
lines; an empty table gives no rows; further columns do not matter, whatever their names."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ddlscope.llm.groups import saved
from ddlscope.llm.texts import Block, blocks, bound_batches, returning

BLANK = b" \t\n\v\f\r"
FOLD = bytes(range(256)).replace(bytes(range(65, 91)), bytes(range(97, 123)))
LOST, OPEN, RUN = 0, 1, 2
KEYED = "high long, low long, doc long, text_key long, lines int, places binary"
STREAMED = f"{KEYED}, what int, largest array<long>"
#: Texts whose rows a task remembers, so as not to hand on those of repeated rows again.
REMEMBERED = 100_000


def line_key(line: bytes, least_chars: int) -> bytes | None:
    """The key of a line, if it is long enough."""
    if len(line) < least_chars:
        return None
    key = line.strip(BLANK).translate(FOLD)
    if len(key) < least_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return key


def _identified(documents: DataFrame) -> DataFrame:
    """doc_id, text, and what a text and its bitmap meet by: the id as a number and 60 bits of a digest of the text."""
    digest = F.substring(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256), 1, 15)
    return documents.select("doc_id", "text", F.col("doc_id").try_cast("long").alias("doc"), F.conv(digest, 16, 10).cast("long").alias("text_key"))


def _keyed(least_chars: int):
    """One row for each text and key, with the places of the key's lines."""
    def keys_of(block: Block, seen: set) -> pa.RecordBatch:
        docs, texts = (block.rows.column(c).to_pylist() for c in ("doc", "text_key"))
        out: list[tuple] = []
        for i, (doc, text_key) in enumerate(zip(docs, texts)):
            if (doc, text_key) in seen:
                continue
            seen.add((doc, text_key))
            lines = block.text(i).split(b"\n")
            found: dict[bytes, list[int]] = {}
            for place, line in enumerate(lines):
                if (key := line_key(line, least_chars)) is not None:
                    found.setdefault(hashlib.blake2b(key, digest_size=16).digest(), []).append(place)
            out += [(h, doc, text_key, len(lines), np.array(p, "<i4").tobytes()) for h, p in found.items()]
        hashes = np.frombuffer(b"".join(r[0] for r in out), "<i8").reshape(-1, 2)
        columns = [pa.array(hashes[:, 0]), pa.array(hashes[:, 1])]
        columns += [pa.array([r[k] for r in out], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.int32()), (4, pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["high", "low", "doc", "text_key", "lines", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for block in blocks(batch):
                if len(seen) > REMEMBERED:
                    seen.clear()
                yield keys_of(block, seen)

    return run


class Stream:
    """One partition's rows in order: those that lose lines go out as soon as that is sure, the others wait for no more than
    the documents before the one that makes them enough."""

    def __init__(self, least_documents: int):
        self.least = least_documents
        self.key: tuple[int, int] | None = None   # of the run that goes on
        self.is_first = True                      # whether that is the partition's first, which may have begun in an earlier one
        self.largest: list[int] = []              # its documents so far, no more than are needed
        self.last: tuple[int, int] | None = None  # document and text of the row before
        self.waiting: list[pa.RecordBatch] = []   # its rows that are not settled

    def out(self, rows: pa.RecordBatch, what: int) -> pa.RecordBatch:
        more = [pa.array(np.full(len(rows), what, np.int32)), pa.nulls(len(rows), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*rows.schema.names, "what", "largest"])

    def close(self, schema: pa.Schema, at_end: bool) -> Iterator[pa.RecordBatch]:
        """The end of the run: an inner one is settled, the first and the last of a partition hand on what they leave open."""
        if self.key is not None and (self.is_first or at_end):
            for rows in self.waiting:
                yield self.out(rows, OPEN)
            high, low = self.key
            row = {"high": [high], "low": [low], "doc": [None], "text_key": [None], "lines": [None], "places": [None]}
            rows = pa.RecordBatch.from_arrays([pa.array(row[f.name], f.type) for f in schema], schema=schema)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([RUN], pa.int32()), pa.array([self.largest], pa.list_(pa.int64()))],
                                             names=[*schema.names, "what", "largest"])
        self.waiting = []

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        high, low, doc, text = (batch.column(c).to_numpy() for c in ("high", "low", "doc", "text_key"))
        new_run = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
        if self.key == (high[0], low[0]):
            new_run[0] = False
        new_doc = np.r_[True, doc[1:] != doc[:-1]] | new_run
        same_row = np.r_[False, ~new_doc[1:] & (text[1:] == text[:-1])]
        if not new_run[0]:
            new_doc[0] = doc[0] != self.last[0]
            same_row[0] = (doc[0], text[0]) == self.last
        starts = np.flatnonzero(np.r_[True, new_run[1:]])
        counted = np.cumsum(new_doc)
        before = np.where(starts > 0, counted[np.maximum(starts - 1, 0)], 0)
        before[0] -= 0 if new_run[0] else len(self.largest)
        of = np.cumsum(np.r_[True, new_run[1:]]) - 1
        rank = counted - before[of]  # 1 for the largest document of the run; once enough are seen, at least that many
        ends = np.r_[starts[1:], len(doc)]
        enough = rank[ends - 1] >= self.least
        was_first = np.zeros(len(starts), bool)
        if not new_run[0]:
            was_first[0] = self.is_first
        elif self.key is None:
            was_first[0] = True
        lost = enough[of] & (rank > 1) & ~same_row
        if not new_run[0] and enough[0] and self.waiting:
            # The largest document's own rows wait only in a first run, and still do; the others lose their lines.
            rows = pa.Table.from_batches(self.waiting).combine_chunks().to_batches()[0]
            top = rows.column("doc").to_numpy() == self.largest[0]
            yield self.out(rows.filter(pa.array(~top)), LOST)
            self.waiting = [rows.filter(pa.array(top))] if top.any() else []
        if lost.any():
            yield self.out(batch.filter(pa.array(lost)), LOST)
        # What waits: the largest document's rows in a partition's first run, and others while there are not enough documents.
        waits = ~same_row & np.where(rank == 1, was_first[of], ~enough[of])
        for k in sorted({0, len(starts) - 1}):
            a, b = int(starts[k]), int(ends[k])
            if new_run[a]:
                if k or self.key is not None:
                    yield from self.close(batch.schema, False)
                self.is_first, self.largest = bool(was_first[k]), []
                self.key = (int(high[a]), int(low[a]))
            some = waits[a:b]
            if some.any():
                self.waiting.append(batch.slice(a, b - a).filter(pa.array(some)))
            fresh = doc[a:b][new_doc[a:b]]
            self.largest = [*self.largest, *fresh[:self.least].tolist()][:self.least]
        self.last = (int(doc[-1]), int(text[-1]))


def _streamed(least_documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, schema = Stream(least_documents), None
        for batch in batches:
            if len(batch):
                schema = batch.schema
                yield from state.take(batch)
        if schema is not None:
            yield from state.close(schema, True)
    return run


def pack(lines: int, lost: np.ndarray) -> bytes:
    """A bitmap with a bit for each line, 1 where it stays, compressed where that makes it smaller; the first byte says which."""
    keep = np.ones(lines, bool)
    keep[lost] = False
    bits = np.packbits(keep).tobytes()
    small = zlib.compress(bits, 6)
    return b"\x01" + small if len(small) < len(bits) else b"\x00" + bits


def unpack(bitmap: bytes, lines: int) -> np.ndarray:
    bits = zlib.decompress(bitmap[1:]) if bitmap[:1] == b"\x01" else bitmap[1:]
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=lines).astype(bool)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [pack(n, np.frombuffer(b"".join(p), "<i4")) for n, p in zip(batch.column("lines").to_pylist(), batch.column("places").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "text_key", "lines")), pa.array(maps, pa.binary())],
                                         names=["doc", "text_key", "lines", "keep"])


def keep_bitmaps(documents: DataFrame, least_chars: int = 20, least_documents: int = 3) -> DataFrame:
    """doc, text_key, lines and the bitmap `keep`, for each text that loses lines; a text without a row keeps all."""
    if least_documents < 2:
        raise ValueError("a line has to stand in two documents at least to be repeated")
    bound_batches(documents.sparkSession)
    rows = _identified(documents).filter("doc IS NOT NULL").select("doc", "text_key", "text")
    # Written, since the range partitioning reads it twice: once for its split points.
    keyed = saved(rows.mapInArrow(returning(_keyed(least_chars)), KEYED), "line-keys")
    order = ["high", "low", F.col("doc").desc(), "text_key"]
    streamed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_streamed(least_documents), STREAMED)
    streamed = saved(streamed, "line-runs")
    # At most two rows for each partition, with so many documents as make a line repeated: small, whatever the data.
    runs = (streamed.filter(F.col("what") == RUN).groupBy("high", "low")
            .agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("largest"))), False), 1, least_documents).alias("all"))
            .filter(F.size("all") >= least_documents).select("high", "low", F.col("all")[0].alias("keeper")))
    settled = streamed.filter(F.col("what") == OPEN).join(F.broadcast(runs), ["high", "low"]).filter(F.col("doc") < F.col("keeper"))
    columns = ["doc", "text_key", "lines", "places"]
    lost = streamed.filter(F.col("what") == LOST).select(*columns).union(settled.select(*columns))
    by_text = lost.groupBy("doc", "text_key").agg(F.max("lines").alias("lines"), F.collect_list("places").alias("places"))
    return by_text.mapInArrow(_packed, "doc long, text_key long, lines int, keep binary")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch):
            counts, dropped, left = [], [], []
            for i, keep in enumerate(block.rows.column("keep").to_pylist()):
                lines = block.text(i).split(b"\n")
                counts.append(len(lines))
                stay = lines if keep is None else [x for x, k in zip(lines, unpack(keep, len(lines)).tolist()) if k]
                dropped.append(len(lines) - len(stay))
                left.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "text"])


def without_repeated_lines(documents: DataFrame, least_chars: int = 20, least_documents: int = 3) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that is left, for every row (doc_id, text)."""
    keep = keep_bitmaps(documents, least_chars, least_documents).select("doc", "text_key", "keep")
    kind = documents.schema["doc_id"].dataType.simpleString()
    joined = _identified(documents).join(keep, ["doc", "text_key"], "left").select("doc_id", "text", "keep")
    return joined.mapInArrow(returning(_applied), f"doc_id {kind}, n_lines long, n_dropped long, text string")
