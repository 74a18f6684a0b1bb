"""Near-duplicate groups by SuperMinHash signatures, banding, verification on full sets and union-find.

SuperMinHash gives every shingle a random permutation of the slots; the shingle offers slot p of rank j the value j + r. The
ranks of one shingle differ between slots, so the slots' values are correlated in a way that lowers the variance of the
estimate, and once every slot of a text has a value below j, no shingle can better it in rank j: most texts end after a few
ranks. Here a rank of all shingles of a block is one step on arrays.

Texts with equal sets are one class, and only classes go on. Bands of the signature bring classes together in buckets; with 40
bands of 5, a pair at a similarity of 0.8 is missed by all bands once in ten million. A bucket never gives all its pairs:

1. Each member is checked against the least member, the bucket's centre, on the full sets.
2. Members that are near to a centre (half alike or more) but not all in one component yet are compared exactly by what sets
   each apart from the centre, a small part of its set: for sets x, y and c, x and y differ where their differences from c
   differ. This goes on in tiles of bounded size, which give no pairs but the links that join two components.
3. What is left in a bucket of several components are members that share little with the centre. Their pairs, but for those
   that step 2 has compared, are checked on the full sets where sizes and a sketch of the signature allow a link; the sketch is
   given six standard deviations.

A class has a number of its own, and is named by the least id of its documents only at the end; so an id may stand on several texts.

Defined cases: a text with fewer words than a shingle is one shingle, one without words is linked with nothing; repeated rows
stand for themselves, so copies share a component; texts that share an id are texts of their own, and are named by it like any; a null
id is left out of the links and is its own group (component null, kept); an empty table gives an empty result; extra columns
are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ddlscope.llm.groups import components, saved
from ddlscope.llm.texts import FOLDED, Block, bound_batches, map_blocks, mix, ranges, sequence, text_key

BANDS, WIDTH = 40, 5
SLOTS = BANDS * WIDTH
#: Of estimated similarity, below the threshold by six standard deviations of the sketch.
SLACK = 0.2
#: Members and bytes of half a tile, and the similarity from which a member is near to a centre.
TILE, TILE_BYTES, NEAR = 2000, 16 << 20, 50
RANK = np.uint64(56)


def shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, by row and hash."""
    words = block.words(FOLDED)
    begins, hashes = block.windows(words, size)
    rows = block.row[begins]
    short = np.flatnonzero((block.n_words > 0) & (block.n_words < size))
    if len(short):
        first, last = block.first[short], block.first[short + 1]
        ones = np.array([mix(sequence(words[a:b], b - a))[0] + np.uint64(b - a) for a, b in zip(first, last)], np.uint64)
        rows, hashes = np.r_[rows, short], np.r_[hashes, ones]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def signatures(rows: np.ndarray, hashes: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """The SuperMinHash signature of each text: in each slot the rank in the top byte, the random part below."""
    out = np.full((texts, slots), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)

    def offer(rank: int, at: np.ndarray) -> np.ndarray:
        """The draws of this rank: the place to swap with."""
        return rank + (mix(at, 2 * rank) % np.uint64(slots - rank)).astype(np.int64)

    def put(rank: int, text: np.ndarray, slot: np.ndarray, at: np.ndarray) -> None:
        value = (np.uint64(rank) << RANK) | (mix(at, 2 * rank + 1) >> np.uint64(8))
        np.minimum.at(flat, text * slots + slot, value)

    if not len(rows):
        return out
    drawn = offer(0, hashes)
    put(0, rows, drawn, hashes)
    counts = np.bincount(rows, minlength=texts)
    first = np.r_[0, np.cumsum(counts)]
    going = np.flatnonzero((counts > 0) & (out.max(axis=1) >= np.uint64(1) << RANK))
    low = 0
    while low < len(going):  # texts together whose permutations fit in a bounded array
        high = low + max(1, int(np.searchsorted(np.cumsum(counts[going[low:]]), 40_000, "right")))
        some = going[low:high]
        low = high
        at = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
        text, hash_ = rows[at], hashes[at]
        order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(at), 1))
        order[np.arange(len(at)), drawn[at]] = 0
        for rank in range(1, slots):
            each, k = np.arange(len(text)), offer(rank, hash_)
            put(rank, text, order[each, k].astype(np.int64), hash_)
            order[each, k] = order[:, rank]
            done = out[some].max(axis=1) < np.uint64(rank + 1) << RANK
            if done.any():
                some = some[~done]
                if not len(some):
                    break
                stay = np.isin(text, some)
                text, hash_, order = text[stay], hash_[stay], order[stay]
    return out


def sums(rows: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
    """Sum of each text's values, modulo 2**64."""
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)]
    ends = np.searchsorted(rows, np.arange(texts + 1))
    return total[ends[1:]] - total[ends[:-1]]


def digests(rows: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that are equal for equal sets."""
    return tuple(sums(rows, mix(hashes, salt), texts).view(np.int64) for salt in (101, 102))


def sign(documents: DataFrame, size: int) -> DataFrame:
    def step(block: Block) -> pa.RecordBatch:
        rows, hashes = shingles(block, size)
        n = np.bincount(rows, minlength=len(block))
        d1, d2 = digests(rows, hashes, len(block))
        signed = signatures(rows, hashes, len(block))
        weights = mix(np.arange(SLOTS, dtype=np.uint64), 103) | np.uint64(1)
        keys = mix((signed * weights).reshape(-1, BANDS, WIDTH).sum(axis=2, dtype=np.uint64)).view(np.int64)
        bits = (signed[:, :, None] >> np.arange(2, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).reshape(len(block), -1)
        sketch = np.packbits(bits, axis=1)
        bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS).cast(pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [block.rows.column("doc_id").cast(pa.int64()), block.rows.column("text_key"), pa.array(n.astype(np.int64)), pa.array(d1), pa.array(d2), bands,
             pa.array([s.tobytes() for s in sketch], pa.binary())], names=["doc_id", "text_key", "n", "d1", "d2", "bands", "sketch"])
    return map_blocks(documents.select("doc_id", "text", text_key().alias("text_key")), step,
                      "doc_id long, text_key long, n long, d1 long, d2 long, bands array<long>, sketch binary")


def sets_of(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The full set of each wanted class, from the text of the row that stands for it."""
    def step(block: Block) -> pa.RecordBatch:
        rows, hashes = shingles(block, size)
        d1, d2 = digests(rows, hashes, len(block))
        same = (d1 == block.rows.column("d1").to_numpy()) & (d2 == block.rows.column("d2").to_numpy())
        ends = np.searchsorted(rows, np.arange(len(block) + 1))
        keep = np.flatnonzero(same)
        return pa.RecordBatch.from_arrays(
            [block.rows.column("rep").take(pa.array(keep)), pa.array([hashes[ends[i]:ends[i + 1]].tobytes() for i in keep], pa.binary())],
            names=["rep", "shingles"])
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("text_key"))
    texts = texts.join(wanted.select("rep", "d1", "d2", F.col("who.doc_id").alias("doc_id"), F.col("who.text_key").alias("text_key")), ["doc_id", "text_key"])
    return map_blocks(texts.select("rep", "d1", "d2", "text"), step, "rep long, shingles binary").dropDuplicates(["rep"])


def near_sizes(a: Column | str, b: Column | str, percent: int) -> Column:
    """Whether sets of these sizes can be that similar."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with `linked`: 100 * intersection >= percent * union of their full sets; and for b near to a, `apart`, the
    shingles that only one of them has."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, apart = [], []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                both = np.frombuffer(x + y, np.uint64).copy()
                both.sort()
                same = both[1:] == both[:-1]
                common = int(same.sum())
                union = len(both) - common
                linked.append(100 * common >= percent * union)
                lone = ~(np.r_[same, False] | np.r_[False, same])
                apart.append(both[lone].tobytes() if 100 * common >= NEAR * union else None)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_()), pa.array(apart, pa.binary())],
                                             names=["a", "b", "linked", "apart"])
    bound_batches(pairs.sparkSession)
    with_b = pairs.select("a", "b").join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    with_both = with_b.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
    return with_both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long, linked boolean, apart binary")


def tiles(members: DataFrame, key: str, size: Column, more: DataFrame | None = None) -> DataFrame:
    """The members of each key that has several roots, with the columns of `more` by rep, cut into blocks, once for each pair of
    blocks: lo, hi, and part. Blocks are bounded by their members and by the bytes that `size` gives of each."""
    mixed = members.groupBy(key).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m"), F.sum(size).alias("bytes")).filter("low <> high")
    parts = F.greatest(F.ceil(F.col("m") / F.lit(TILE)), F.ceil(F.col("bytes") / F.lit(TILE_BYTES)), F.lit(1)).cast("int")
    # Written, so that the join below reads both sides from a shuffle of its own, in which a hot key is split.
    mixed = saved(mixed.select(key, parts.alias("parts")), "mixed")
    cut = members.join(mixed, key).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    cut = cut.join(more, "rep") if more is not None else cut
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda other: F.struct(F.least("part", other).alias("lo"), F.greatest("part", other).alias("hi")))
    cut = cut.withColumn("tile", F.explode(pairs))
    cut = cut.withColumns({"lo": F.col("tile.lo"), "hi": F.col("tile.hi")}).drop("tile", "parts")
    # The tiles of one key would stay in the task that the key was dealt to.
    return cut.repartition(key, "lo", "hi")


def to_compare(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Columns of a tile, and the members to compare with all of other roots: those not of the commonest root. A pair of roots is
    only left out if it is one root with itself."""
    group = {c: table.column(c).to_numpy() for c in ("part", "rep", "n", "root")}
    roots, which, counts = np.unique(group["root"], return_inverse=True, return_counts=True)
    return group, np.flatnonzero(which != np.argmax(counts))


def linked_by_difference(members: DataFrame, percent: int) -> DataFrame:
    """Links between members of one centre that are of different roots, from their differences to the centre (`apart`): in each tile no more than
    join what was not joined."""
    def links(table: pa.Table) -> pa.Table:
        group, some = to_compare(table)
        n, root = group["n"].astype(np.int64), group["root"].copy()
        apart = [np.frombuffer(x, np.uint64) for x in table.column("apart").to_pylist()]
        sizes = np.array([len(x) for x in apart])
        owner, hashes = np.repeat(np.arange(len(apart)), sizes), np.concatenate(apart)
        order = np.argsort(hashes, kind="stable")
        owner, hashes = owner[order], hashes[order]
        found_a, found_b = [], []
        for i in some.tolist():
            low, high = np.searchsorted(hashes, apart[i]), np.searchsorted(hashes, apart[i], "right")
            common = np.bincount(owner[ranges(low, high - low)], minlength=len(n))
            differ = sizes[i] + sizes - 2 * common
            # 100 * intersection >= percent * union, with intersection = (|x| + |y| - differ) / 2 and union = (|x| + |y| + differ) / 2
            alike = 100 * (n[i] + n - differ) >= percent * (n[i] + n + differ)
            for j in np.flatnonzero(alike & (root != root[i])).tolist():
                if root[j] != root[i]:
                    found_a.append(group["rep"][i])
                    found_b.append(group["rep"][j])
                    root[root == root[j]] = root[i]
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return tiles(members, "centre", F.octet_length("apart")).groupBy("centre", "lo", "hi").applyInArrow(links, "a long, b long")


def similar_across(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one bucket, of different roots and not near to a common centre, that can reach the threshold by
    size and sketch. `classes` has rep, sketch and the centres that are near."""
    least = percent / 100 - SLACK

    def pairs(table: pa.Table) -> pa.Table:
        group, some = to_compare(table)
        bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(table), -1)
        near = [set(x or ()) for x in table.column("near").to_pylist()]
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        n, root, part = group["n"], group["root"], group["part"]
        found_a, found_b = [], []
        for i in some.tolist():
            across = (root != root[i]) & (np.minimum(n, n[i]) * 100 >= np.maximum(n, n[i]) * percent)
            others = np.flatnonzero(across if lo == hi else across & (part != part[i]))
            if not len(others):
                continue
            differ = bits[others] ^ bits[i]
            slots = np.bitwise_count((differ | differ >> np.uint8(1)) & np.uint8(0x55)).sum(axis=1)
            for j in others[1 - (slots / SLOTS) / 0.75 >= least].tolist():
                if near[i].isdisjoint(near[j]):
                    found_a.append(min(group["rep"][i], group["rep"][j]))
                    found_b.append(max(group["rep"][i], group["rep"][j]))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())}).group_by(["a", "b"]).aggregate([])

    return tiles(members, "key", F.lit(SLOTS // 4), classes).groupBy("key", "lo", "hi").applyInArrow(pairs, "a long, b long").distinct()


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    joined = rows.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    return joined.withColumn("root", F.coalesce("root", "rep"))


def grouped(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and `stays` for every row of `documents` (doc_id, text): of the rows of a group those
    with the least id stay, and of texts that share this id one."""
    signed = saved(sign(documents, size), "signed")
    classes = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n").agg(
        F.min(F.struct("doc_id", "text_key")).alias("who"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    # Numbered as they are written, so that the numbers stay.
    classes = saved(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    rows = classes.select(F.col("rep").alias("rep"), "n", F.posexplode("bands").alias("band", "key"))
    rows = rows.select("rep", "n", F.xxhash64("band", "key").alias("key"))
    buckets = rows.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("c"), F.count("*").alias("m")).filter("m > 1")
    met = saved(rows.join(buckets, "key").select("key", "rep", "n", F.col("c.rep").alias("centre"), F.col("c.n").alias("centre_n")), "met")
    wanted = classes.join(met.select("rep").distinct(), "rep", "left_semi")
    sets = saved(sets_of(documents, wanted, size), "sets")
    stars = met.filter(F.col("rep") != F.col("centre")).select(F.col("centre").alias("a"), F.col("rep").alias("b"), near_sizes("n", "centre_n", NEAR).alias("can"))
    stars = saved(verified(stars.filter("can").select("a", "b").distinct(), sets, percent), "stars")
    links = stars.filter("linked").select("a", "b")
    roots = components(links)
    near = stars.filter("apart IS NOT NULL").select(F.col("a").alias("centre"), F.col("b").alias("rep"), "apart")
    centres = near.select("centre", F.col("centre").alias("rep"), F.lit(b"").alias("apart")).distinct()
    near = near.union(centres)
    members = with_roots(near.join(classes.select("rep", "n"), "rep"), roots).select("centre", "rep", "n", "root", "apart")
    found = saved(linked_by_difference(members, percent), "links")
    if not found.isEmpty():
        links = links.union(found)
        roots = components(links)
    compared = near.groupBy("rep").agg(F.collect_set("centre").alias("near"))  # no more than a class has bands, and itself
    sketches = classes.select("rep", "sketch").join(compared, "rep", "left")
    pairs = similar_across(with_roots(met.select("key", "rep", "n"), roots), sketches, percent)
    found = saved(verified(pairs, sets, percent).filter("linked").select("a", "b"), "links")
    if not found.isEmpty():
        roots = components(links.union(found))
    of_root = with_roots(classes.select("d1", "d2", "n", "rep", "who"), roots)
    least = of_root.groupBy("root").agg(F.min("who").alias("first"))
    named = of_root.join(least, "root").select("d1", "d2", "n", "first")
    out = signed.select("doc_id", "text_key", "n", "d1", "d2").join(named, ["d1", "d2", "n"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    component = F.when(linked, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    stays = ~linked | ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), stays.alias("stays"))


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `documents` (doc_id, text)."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return grouped(documents, size, percent).select("doc_id", "n_shingles", "component_id", kept)
