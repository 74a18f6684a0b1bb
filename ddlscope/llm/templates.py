"""Benchmark decontamination by template canonicalisation.

Every token of a text is put in canonical form: outer punctuation off, lower case; a number, a unit and a name (a capitalised word
within a sentence) become a placeholder of their type, with the word as the value of that slot. Windows of canonical tokens of the
documents are joined by their hash with those of the benchmark, so a question whose numbers, names and units were changed still
matches. On each alignment (document, item, difference of places) the slots are then checked: a value of the item has to stand for one value
of the document throughout, and the other way round. A match with other values that passes is a re-parameterised question; one that
fails is a coincidence, unless most of its slots are equal.

Whether a word is a name hangs on its capital and on what stands before it, which a copy need not share. So a window has further
forms: with names kept as words in lower case, and, in a document, with its first word plain, as an item's first word is. A
place matches if any form of the one equals a form of the other.

A document's windows are looked up in a bitmap of the benchmark's hashes before they are shuffled for the join, which decides. It
has 64 bits or more for each hash, 2**`MOST_BITS` at most, which bounds what is broadcast; a fuller one only lets more pass.

Evidence is an alignment with `need` matching windows, or all windows of a shorter item: among the windows with placeholders for
names, or among all. A third of a window's words have to be plain, so that rows of numbers are none.

An item without a usable window is looked for whole. One of fewer tokens than a window is one window of its own length; its
template counts if `LEAST_PLAIN` words or more are plain, and otherwise its words, numbers and units as they are, in any case. A
longer one, of which too few words are plain, is looked for by windows of its own values, all of which have to match.

Defined cases: null or empty texts have no windows, and an item without a word or number is not looked for; null ids of
documents are reported as such where they match; a repeated row or item counts once; texts that share an id are checked each by
itself, and the best match of them is reported; an empty table gives no matches; extra columns are not read."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ddlscope.llm.texts import EXACT, Block, Store, blocks, bound_batches, mix, returning, text_key

FILTER_BITS, MOST_BITS = 22, 30
#: The bitmap reaches the driver in pieces of 2**this bits.
PIECE_BITS = 16
SIZE, NEED = 8, 6
#: A template of fewer tokens than a window says little with fewer plain words than these.
LEAST_PLAIN = 5
PLAIN, NUMBER, UNIT, EMPTY = 0, 1, 2, 3
NAME = 4
SALTS = np.array([0, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0, 0x8EBC6AF09C88C6E3], np.uint64)
# Units and numbers in words, in English.
UNITS = frozenset("""mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces
pound pounds lb lbs ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week
weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent % degree degrees celsius fahrenheit kelvin
meter meters metre metres kilometer kilometers kilometre kilometres kmh mph watt watts volt volts joule joules byte bytes""".split())
NUMBERS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half twice
dozen""".split())
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
DIGITS = re.compile(r"^[\d.,:/'-]*\d[\d.,:/'-]*(st|nd|rd|th|s)?$")


class Canonical(Store):
    """Type, hash of the canonical word, whether it is capitalised and whether it ends a sentence, of each distinct word."""

    def clear(self) -> None:
        super().clear()
        self.types, self.hashes = np.zeros(0, np.int8), np.zeros(0, np.uint64)
        self.capital, self.stops = np.zeros(0, bool), np.zeros(0, bool)

    def add(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        bare = [EDGES.sub("", t) for t in texts]
        lower = [b.lower() for b in bare]
        types = [(UNIT if "%" in t else EMPTY) if not b else NUMBER if DIGITS.match(b) or b in NUMBERS else UNIT if b in UNITS else PLAIN
                 for t, b in zip(texts, lower)]
        joined = " ".join(b or "%" for b in lower).encode()
        block = next(blocks(pa.RecordBatch.from_arrays([pa.array([joined], pa.binary())], names=["text"])))
        # One hash for each word: a canonical word has no space in it.
        self.types = np.r_[self.types, np.array(types, np.int8)]
        self.hashes = np.r_[self.hashes, block.words(EXACT)]
        self.capital = np.r_[self.capital, np.array([b[:1].isupper() and not b[1:].isupper() for b in bare], bool)]
        self.stops = np.r_[self.stops, np.array([t.rstrip("\"')]»”’")[-1:] in tuple(".!?…:") for t in texts], bool)]


@dataclass
class Tokens:
    """The tokens of a block that are not empty: type, whether a name, hash of the word in lower case, and row."""

    types: np.ndarray
    named: np.ndarray
    hashes: np.ndarray
    row: np.ndarray
    n_rows: int

    @classmethod
    def of(cls, block: Block, store: Canonical) -> Tokens:
        at, row = store.rows(block, block.words(EXACT)), block.row
        types = store.types[at]
        begins = np.ones(len(at), bool)
        begins[1:] = (row[1:] != row[:-1]) | store.stops[at][:-1]
        named = (types == PLAIN) & store.capital[at] & ~begins
        full = types != EMPTY
        return cls(types[full], named[full], store.hashes[at][full], row[full], len(block))


@dataclass
class Found:
    """Windows: row, place, hash, whether names are placeholders (null where all values are as they are), and the slots."""

    row: np.ndarray
    at: np.ndarray
    hash: np.ndarray
    template: pa.Array
    slots: Slots

    def __getitem__(self, which: np.ndarray) -> Found:
        slots = Slots(self.slots.values, self.slots.at[which], self.slots.size)
        return Found(self.row[which], self.at[which], self.hash[which], self.template.take(pa.array(which)), slots)


def windows(tokens: Tokens, size: int, of_items: bool) -> Found:
    """Each form of the windows with enough plain words."""
    types, named, hashes, row = tokens.types, tokens.named, tokens.hashes, tokens.row
    # A value of a document is asked for where the item has a slot.
    values = np.where((types != PLAIN) | named | (not of_items), hashes | np.uint64(1), np.uint64(0))
    count = max(len(row) - size + 1, 0)
    first = np.searchsorted(row, np.arange(tokens.n_rows))
    words = mix(np.where(types != PLAIN, SALTS[types], hashes))
    names = np.where(named, mix(SALTS[NAME:]) - words, np.uint64(0))
    weights = mix(np.arange(size, dtype=np.uint64), 31) | np.uint64(1)
    total, change = np.zeros((2, count), np.uint64)
    slots, n_names = np.zeros((2, count), np.int64)
    for k in range(size):
        total += words[k:k + count] * weights[k]
        change += names[k:k + count] * weights[k]
        slots += types[k:k + count] != PLAIN
        n_names += named[k:k + count]
    inside, most = row[:count] == row[size - 1:size - 1 + count], size - -(-size // 3)
    kept = inside & (slots <= most) & (n_names > 0)
    placed = inside & (slots + n_names <= most)
    forms = [(placed, total + change, True), (kept, total, False)]
    if not of_items:
        forms.append((inside & named[:count] & (n_names > 1) & (slots + n_names - 1 <= most), total + change - names[:count] * weights[0], True))
    some = [np.flatnonzero(which) for which, _, _ in forms]
    hashed = np.concatenate([mix(sums[at]) for at, (_, sums, _) in zip(some, forms)])
    template = np.repeat([flag for _, _, flag in forms], [len(at) for at in some])
    some = np.concatenate(some)
    return Found(row[some], some - first[row[some]], hashed, pa.array(template, pa.bool_()), Slots(values, some, size))


def own_windows(tokens: Tokens, size: int, of_items: bool) -> Found:
    """All windows, with numbers, units and names as they are; those shorter than `SIZE` in a document once for each hash."""
    row, count = tokens.row, max(len(tokens.row) - size + 1, 0)
    words, total = mix(tokens.hashes, 32), np.zeros(count, np.uint64)
    for k in range(size):
        total += words[k:k + count] * (mix(np.full(1, k, np.uint64), 33) | np.uint64(1))
    some = np.flatnonzero(row[:count] == row[size - 1:size - 1 + count])
    hashed = mix(total[some])
    if size < SIZE and not of_items:
        order = np.lexsort((hashed, row[some]))
        r, h = row[some][order], hashed[order]
        again = np.zeros(len(order), bool)
        again[1:] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
        keep = np.sort(order[~again])
        some, hashed = some[keep], hashed[keep]
    values = np.where((tokens.types != PLAIN) | tokens.named | (not of_items), tokens.hashes | np.uint64(1), np.uint64(0))
    first = np.searchsorted(row, np.arange(tokens.n_rows))
    return Found(row[some], some - first[row[some]], hashed, pa.nulls(len(some), pa.bool_()), Slots(values, some, size))


def of_item(tokens: Tokens, size: int) -> Iterator[Found]:
    """The windows of items, and for those without a usable one what stands for the whole."""
    found = windows(tokens, size, True)
    yield found
    lengths = np.bincount(tokens.row, minlength=tokens.n_rows)
    plain = np.bincount(tokens.row, (tokens.types == PLAIN) & ~tokens.named, tokens.n_rows)
    left = lengths > 0
    left[found.row] = False
    for n in np.unique(np.minimum(lengths[left], size)).tolist():
        mine = left & (np.minimum(lengths, size) == n)
        by_template = mine & (n < size) & (plain >= LEAST_PLAIN)
        for make, rows in ((windows, by_template), (own_windows, mine & ~by_template)):
            if rows.any():
                some = make(tokens, n, True)
                yield some[np.flatnonzero(rows[some.row])]


@dataclass
class Slots:
    """Slot values of the tokens of windows (0 for a plain word), formed for those that are asked for."""

    values: np.ndarray
    at: np.ndarray
    size: int

    def __getitem__(self, which: np.ndarray) -> np.ndarray:
        return self.values[self.at[which][:, None] + np.arange(self.size)]


def window_table(rows: DataFrame, size: int, bitmap: bytes | None = None, kinds: list[tuple[int, bool]] | None = None) -> DataFrame:
    """id, place, hash, template and slots of the windows of a table (id, text) of items; with a bitmap, of documents: the windows
    in it, of the given lengths and of their own values or not."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Canonical()
        table = np.frombuffer(shared.value, np.uint8) if shared else None
        bits = (len(table) << 3).bit_length() - 1 if shared else 0
        for batch in batches:
            for block in blocks(batch):
                tokens = Tokens.of(block, store)
                if table is None:
                    several = of_item(tokens, size)
                else:
                    several = ((own_windows if own else windows)(tokens, n, False) for n, own in kinds)
                for found in several:
                    keep = np.arange(len(found.row))
                    if table is not None:
                        bit = (found.hash >> np.uint64(64 - bits)).astype(np.int64)
                        keep = np.flatnonzero(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                    if len(keep):
                        some = found[keep]
                        values = some.slots[np.arange(len(keep))].view(np.int64).reshape(-1)
                        lists = pa.FixedSizeListArray.from_arrays(pa.array(values), some.slots.size).cast(pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_arrays([block.rows.column("id").take(pa.array(some.row)), pa.array(some.at.astype(np.int64)),
                                                          pa.array(some.hash.view(np.int64)), some.template, lists],
                                                         names=["id", "at", "hash", "template", "slots"])

    bound_batches(rows.sparkSession)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(returning(run), f"id {kind}, at long, hash long, template boolean, slots array<long>")


def bitmap(hashes: DataFrame) -> bytes:
    """A bit for each hash, of as many bits as suit their number."""
    bits = min(MOST_BITS, max(FILTER_BITS, (64 * hashes.distinct().count()).bit_length()))

    def pack(table: pa.Table) -> pa.Table:
        some = np.zeros(1 << PIECE_BITS, np.uint8)
        some[table.column("at").to_numpy()] = 1
        return pa.table({"piece": table.column("piece")[:1], "bits": pa.array([np.packbits(some, bitorder="little").tobytes()], pa.binary())})

    bit = F.shiftrightunsigned("hash", 64 - bits)
    at = hashes.select(F.shiftright(bit, PIECE_BITS).cast("int").alias("piece"), bit.bitwiseAND((1 << PIECE_BITS) - 1).cast("int").alias("at")).distinct()
    out = np.zeros((1 << bits - PIECE_BITS, 1 << PIECE_BITS - 3), np.uint8)
    for row in at.groupBy("piece").applyInArrow(pack, "piece int, bits binary").toLocalIterator():
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def leaks(documents: DataFrame, benchmark: DataFrame, size: int = SIZE, need: int = NEED) -> DataFrame:
    """One row for each document (doc_id, text) and item (item_id, text) that it holds: doc_id, item_id, n_windows of the item, n_matched
    on the best alignment, n_slots, n_same of them with the item's own value, and kind: verbatim or reparameterised."""
    items = window_table(benchmark.select(F.col("item_id").alias("id"), "text").distinct(), size)
    items = items.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "hash", "template", F.col("slots").alias("item_slots"))
    places = lambda which: F.when(which, F.col("item_at"))
    # By placeholders for names, in one form or the other, and by own values.
    by = {"template": places(F.col("template")), "form": places(F.col("template").isNotNull()), "own": places(F.col("template").isNull())}
    sizes = items.groupBy("item_id").agg(F.countDistinct("item_at").alias("n_windows"),
                                         *(F.countDistinct(at).alias(f"n_{name}") for name, at in by.items()))
    # No more than two kinds for each length up to `size`.
    kinds = [tuple(r) for r in items.select(F.size("item_slots"), F.col("template").isNull()).distinct().collect()]
    # A document is its id and its text: windows of two texts do not make up one alignment.
    found = window_table(documents.select(F.struct("doc_id", text_key().alias("text_key")).alias("id"), "text"), size, bitmap(items.select("hash")), kinds).drop("template")
    met = found.join(items, "hash").select(F.col("id").alias("doc_id"), "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "item_at",
                                           "template", "slots", "item_slots")
    pair = F.arrays_zip(F.sequence("item_at", F.col("item_at") + F.size("item_slots") - 1).alias("place"), F.col("item_slots").alias("own"), F.col("slots").alias("seen"))
    pairs = F.filter(pair, lambda p: p["own"] != 0)
    on = ["doc_id", "item_id", "shift"]
    # Sets bounded by the item's length: its places, and the slots on them.
    aligned = met.groupBy(*on).agg(F.size(F.collect_set("item_at")).alias("n_matched"),
                                   *(F.size(F.collect_set(at)).alias(f"by_{name}") for name, at in by.items()),
                                   F.array_distinct(F.flatten(F.collect_set(pairs))).alias("slots"))
    own, seen = F.transform("slots", lambda p: p["own"]), F.transform("slots", lambda p: p["seen"])
    both = F.transform("slots", lambda p: F.struct(p["own"], p["seen"]))
    distinct = lambda x: F.size(F.array_distinct(x))
    checked = aligned.select(*on, "n_matched", *(f"by_{name}" for name in by), F.size("slots").alias("n_slots"), F.size(F.filter("slots", lambda p: p["own"] == p["seen"])).alias("n_same"),
                             ((distinct(both) == distinct(own)) & (distinct(both) == distinct(seen))).alias("consistent"))
    least = {"template": F.least(F.lit(need), "n_template"), "form": F.least(F.lit(need), "n_form"), "own": F.col("n_own")}
    enough = F.lit(False)
    for name, at_least in least.items():
        enough = enough | ((F.col(f"n_{name}") > 0) & (F.col(f"by_{name}") >= at_least))
    good = checked.join(sizes, "item_id").filter(enough & (F.col("consistent") | (2 * F.col("n_same") >= F.col("n_slots"))))
    best = good.groupBy(F.col("doc_id.doc_id").alias("doc_id"), "item_id", "n_windows").agg(F.max(F.struct("n_matched", "n_same", F.negative("n_slots").alias("less"), "shift")).alias("b"))
    n_slots = F.negative("b.less")
    return best.select("doc_id", "item_id", F.col("n_windows").cast("long"), F.col("b.n_matched").cast("long").alias("n_matched"), n_slots.cast("long").alias("n_slots"),
                       F.col("b.n_same").cast("long").alias("n_same"),
                       F.when(F.col("b.n_same") == n_slots, "verbatim").otherwise("reparameterised").alias("kind"))
