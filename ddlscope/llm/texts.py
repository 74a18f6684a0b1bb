"""Words of whole texts as arrays: the helper that runs inside the tasks of the operators on text.

A word is a longest run of characters other than space and U+0009 to U+000D. Both are single bytes in UTF-8, so words are
found in the bytes. Texts come in blocks of a megabyte, which bounds the memory of a task; a longer text is a block of
its own. A null text has no words, as an empty one."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLOCK_BYTES = 1 << 20


def marks(some: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(some)] = True
    return table


SPACE = marks(b" \t\n\v\f\r")
NEWLINE = marks(b"\n")
SYMBOL = marks(b"#*$%&|<>")
PUNCTUATION = marks(bytes(i for i in range(33, 127) if not chr(i).isalnum()))
FIRST_BYTE = np.arange(256) & 0xC0 != 0x80  # of a character in UTF-8
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: One random number for each byte, and the same with A to Z as a to z; the base of the polynomial is odd, so it has an inverse.
EXACT = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64)
FOLDED = EXACT[LOWER]
BASE = 0x9E3779B97F4A7C15
#: Pieces of so many bytes have another hash: for long ones, texts can be written whose polynomials are equal whatever the base.
LONG = 128
WINDOW = np.random.default_rng(20240301).integers(1, 2**63, 64, np.uint64) | np.uint64(1)


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit numbers evenly; another salt gives another function."""
    x = values + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)


def powers(base: int, size: int) -> np.ndarray:
    return _powers(base, BLOCK_BYTES + 2 if size <= BLOCK_BYTES + 2 else 1 << size.bit_length())[:size]


@dataclass
class Block:
    """Some rows of a table with the bytes of their texts; `at` has each text's first byte, and the end."""

    rows: pa.RecordBatch
    data: np.ndarray
    at: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.at[i]:self.at[i + 1]].tobytes()

    @cached_property
    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each word."""
        return self.between(SPACE)

    def between(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each longest run of other bytes than these within a text."""
        inner = ~separators[self.data]
        if not inner.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, ends = inner.copy(), inner.copy()
        starts[1:] &= ~inner[:-1]
        ends[:-1] &= ~inner[1:]
        cuts = self.at[(self.at > 0) & (self.at < len(self.data))]
        starts[cuts] = inner[cuts]
        ends[cuts - 1] = inner[cuts - 1]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    @cached_property
    def row(self) -> np.ndarray:
        """The row of each word."""
        return self.row_of(self.bounds[0])

    def row_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, places, "right") - 1

    def counted(self, table: np.ndarray) -> np.ndarray:
        """How many bytes of each text the table marks."""
        return np.diff(np.r_[0, np.cumsum(table[self.data])][self.at])

    @cached_property
    def first(self) -> np.ndarray:
        """The first word of each row, and the number of words."""
        return np.searchsorted(self.bounds[0], self.at)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Running polynomial sums of the bytes, from which the hash of any piece follows."""
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(table[self.data] * powers(BASE, len(self.data) + 1)[:-1], out=out[1:])
        return out

    def pieces(self, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of the bytes of each piece, the same wherever it stands. The table is `EXACT`, or `FOLDED` for A to Z as a to z."""
        sums = self.sums(table) if sums is None else sums
        back = powers(pow(BASE, -1, 2**64), len(self.data) + 1)
        found = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        long = np.flatnonzero(ends - starts >= LONG)
        folds = table[65] == table[97]
        for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist()):
            piece = LOWER[self.data[a:b]] if folds else self.data[a:b]
            found[i] = int.from_bytes(hashlib.blake2b(piece.tobytes(), digest_size=8).digest(), "little")
        return found

    def words(self, table: np.ndarray = EXACT) -> np.ndarray:
        return self.pieces(*self.bounds, table)

    def windows(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all windows of so many consecutive words of one text, and a hash of each window."""
        if len(words) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        count = len(words) - size + 1
        begins = np.flatnonzero(self.row[:count] == self.row[size - 1:])
        return begins, mix(sequence(words, size))[begins]


def sequence(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many words, before mixing."""
    count = len(words) - size + 1
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out += words[k:k + count] * WINDOW[k % 64] + np.uint64(k // 64)
    return out


def blocks(batch: pa.RecordBatch, text: str = "text", most: int = BLOCK_BYTES) -> Iterator[Block]:
    column = pc.fill_null(batch.column(text).cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        high = min(high, len(column))
        yield Block(batch.slice(low, high - low), data[at[low]:at[high]], at[low:high + 1] - at[low])
        low = high


def each_block(step: Callable[[Block], pa.RecordBatch | None], text: str = "text"):
    """A function for `mapInArrow` that applies a step to every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                out = step(block)
                if out is not None and len(out):
                    yield out
    return run


def give_back() -> None:
    """Return freed memory to the system: Python workers live on, and the stages after this one need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def returning(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function for `mapInArrow`, which gives memory back when its task ends."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return wrapped


def map_blocks(rows: DataFrame, step: Callable[[Block], pa.RecordBatch | None], schema: str, text: str = "text") -> DataFrame:
    bound_batches(rows.sparkSession)
    return rows.mapInArrow(returning(each_block(step, text)), schema)


def bound_batches(spark: SparkSession) -> None:
    """Bound what Spark sends to a task's Python at once, also where texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def text_key() -> Column:
    """60 bits of a digest of `text`, which with the id tells rows apart; a null text has that of an empty one."""
    digest = F.substring(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256), 1, 15)
    return F.conv(digest, 16, 10).cast("long")


def record(schema: list[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, schema)],
                                      names=[n for n, _ in schema])


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start, so many of each, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class Store:
    """What is worked out once for each distinct word a task meets, in rows. It begins anew when it has too many."""

    most = 250_000

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.at: dict[int, int] = {}

    def add(self, words: list[bytes]) -> None:
        """Append a row for each word."""
        raise NotImplementedError

    def rows(self, block: Block, hashes: np.ndarray, bounds: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """The row of each word of the block (or other piece, with bounds), given the hashes of all."""
        if len(self.at) > self.most:
            self.clear()
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        found = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            starts, ends = (b[first[new]].tolist() for b in bounds or block.bounds)
            data, known = block.data.tobytes(), len(self.at)
            self.add([data[s:e] for s, e in zip(starts, ends)])
            found[new] = np.arange(known, known + len(new))
            self.at.update(zip(distinct[new].tolist(), range(known, known + len(new))))
        return found[which]
