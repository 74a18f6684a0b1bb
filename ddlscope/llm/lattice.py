"""SentencePiece encoding and decoding: distinct sampled segmentations by a perturbed A-star search over the lattice.

The lattice of a text has an edge for every piece of the vocabulary that fits, and byte pieces for a character that has none.
A piece's probability falls with its rank in the vocabulary (Zipf), to the power `alpha`; the probability of a segmentation
is the product over its pieces, normalised over the lattice by a backward sum. No piece of the vocabulary goes beyond a
run of spaces with the word after it, or beyond a line end, so a text's lattice is a chain of small ones; each is built
once for all its occurrences in a task.

Gumbel top-k: the whole lattice draws a Gumbel number; a part of it keeps the number if the sampled path goes through it, and draws
one below that, with its own log mass, if not. The search pops the part with the greatest number, so the segmentations come in the order
of their perturbed log probabilities: an exact sample without replacement, of which only the popped parts are ever expanded. Part of a
text's lattice is: the path so far, then anything but the paths taken for one word, then anything. The number of the best part that is not
popped is the threshold t from which the probability of a segmentation of log probability l to be included follows:
1 - exp(-exp(l - t)). All draws come from a hash of the row's key and the place, so they do not depend on partitions.

Defined cases: a null or empty text has one segmentation, without pieces, of inclusion 1; a text with fewer segmentations than
`samples` gives all of them; a null key seeds as an empty string; repeated rows give the same samples again; extra columns are not
read."""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ddlscope.llm.texts import EXACT, Block, Store, blocks, bound_batches, mix, ranges, returning

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
OFFSET = 2.7


class Vocabulary:
    """Pieces as bytes, with a space for the mark, their log probabilities, and a trie of them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        hidden = np.array([model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)])
        text = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = np.zeros(256, np.int32)
        pieces = []
        for i, t in enumerate(text):
            if self.is_byte[i]:
                value = int(t[1:-1], 16)
                self.byte_id[value] = i
                pieces.append(bytes([value]))
            else:
                pieces.append(b"" if hidden[i] else t.replace(SPACE_MARK, " ").encode())
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        usable = [i for i in range(size) if pieces[i] and not self.is_byte[i]]
        weights = np.zeros(size)
        weights[usable] = 1 / (np.arange(len(usable)) + OFFSET)
        weights[self.is_byte] = weights[usable].min()
        with np.errstate(divide="ignore"):
            self.log_p = np.log(weights / weights.sum())
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for i in usable:
            node = 0
            for byte in pieces[i]:
                node = edges.setdefault((node, byte), len(edges) + 1)
            ends[node] = i
        nodes = len(edges) + 1
        self.next = np.zeros((nodes, 256), np.uint16 if nodes < 1 << 16 else np.int32)
        keys = np.array(list(edges), np.int64)
        self.next[keys[:, 0], keys[:, 1]] = np.fromiter(edges.values(), np.int64)
        self.piece = np.full(nodes, -1, np.int32)
        self.piece[np.fromiter(ends, np.int64)] = np.fromiter(ends.values(), np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the pieces, one after the other."""
        return self.bytes[ranges(self.starts[ids], self.sizes[ids])]


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices(Store):
    """The lattices of the distinct chunks a task has met. A place is a byte of a chunk; edges are in order of the place, the most
    probable one of a place first."""

    most = 100_000

    def __init__(self, words: Vocabulary, alpha: float):
        self.words, self.log_p = words, words.log_p * alpha
        super().__init__()

    def clear(self) -> None:
        super().clear()
        self.data = np.zeros(0, np.uint8)
        self.starts, self.ends = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.first = np.zeros(0, np.int32)  # the first edge of each place
        self.to, self.id = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.own, self.upto = np.zeros(0), np.zeros(0, np.float32)  # log probability at the place; running sum of it

    def add(self, chunks: list[bytes]) -> None:
        data = np.frombuffer(b"".join(chunks), np.uint8)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        ends = np.cumsum(sizes)
        end_of = np.repeat(ends, sizes)
        head = data & 0xC0 != 0x80
        head[ends - sizes] = True
        places = np.flatnonzero(head)
        after = np.minimum(np.r_[places[1:], len(data)], end_of[places])
        after_of = np.zeros(len(data), np.int64)
        after_of[places] = after
        # All pieces from all places, longer by a byte in each step; `rank` is an edge's place among those of its own.
        step_to = self.words.next.ravel()  # a row of 256 for each node
        begin, state = places, step_to.take(data.take(places)).astype(np.int64)
        found, size = [], 1
        degree, single = np.zeros(len(data), np.int64), np.zeros(len(data), bool)
        while len(begin):
            live = np.flatnonzero(state)
            begin, state = begin.take(live), state.take(live)
            pieces = self.words.piece.take(state)
            hit = np.flatnonzero(pieces >= 0)
            at = begin.take(hit)
            ranks = degree.take(at)
            found.append((at, at + size, pieces.take(hit), ranks))
            degree[at] = ranks + 1
            if size <= 4:  # no character has more bytes
                single[at[at + size == after_of.take(at)]] = True
            more = np.flatnonzero(begin + size < end_of.take(begin))
            begin = begin.take(more)
            state = step_to.take(state.take(more) * 256 + data.take(begin + size)).astype(np.int64)
            size += 1
        bare = places[~single[places]]  # characters without a piece: their bytes
        found.append((bare, after_of[bare], np.full(len(bare), -1, np.int32), degree[bare]))
        degree[bare] += 1
        begin, to, ids, rank = (np.concatenate(x) for x in zip(*found))
        score = self.log_p.take(ids)
        score[len(ids) - len(bare):] = (after_of[bare] - bare) * self.log_p[self.words.byte_id[0]]
        # Backward sums, the places nearest to the end of their chunk first; edges are put in place by counting.
        count = np.cumsum(head)
        level = count[end_of[places] - 1] - count[places]
        by_level = np.argsort(level.astype(np.uint16) if len(level) and level.max() < 1 << 16 else level, kind="stable")
        width = degree[places[by_level]]
        where = np.zeros(len(data), np.int64)
        where[places[by_level]] = np.cumsum(width) - width
        place = where.take(begin) + rank
        # Beyond the end of its chunk an edge meets a mass of 0, which stands after all places.
        target, by_place = np.empty(len(begin), np.int64), np.empty(len(begin))
        target[place] = np.where(to == end_of.take(begin), len(data), to)
        by_place[place] = score
        heads, levels = np.cumsum(width) - width, level[by_level]
        mass = np.zeros(len(data) + 1)
        total = np.empty(len(begin))
        cuts = np.flatnonzero(np.r_[True, levels[1:] != levels[:-1], True]) if len(levels) else np.zeros(0, np.int64)
        edge_at = np.r_[heads, len(begin)]
        for one, two in zip(cuts[:-1], cuts[1:]):
            low, high = edge_at[one], edge_at[two]
            s = by_place[low:high] + mass.take(target[low:high])
            own_heads = heads[one:two] - low
            most = np.maximum.reduceat(s, own_heads)
            mass[places[by_level[one:two]]] = most + np.log(np.add.reduceat(np.exp(s - np.repeat(most, width[one:two])), own_heads))
            total[low:high] = s
        own = total.take(place) - mass.take(begin)
        # In order of the places; the most probable edge of a place is put first, since most draws take it.
        first = np.cumsum(degree) - degree
        place = first.take(begin) + rank
        found = []
        for column in (begin, to, ids, own):
            found.append(np.empty_like(column))
            found[-1][place] = column
        begin, to, ids, own = found
        if len(begin):
            some = first[places]
            best = np.maximum.reduceat(own, some)
            is_best = np.flatnonzero(own == np.repeat(best, degree[places]))
            is_best = is_best[np.r_[True, begin[is_best[1:]] != begin[is_best[:-1]]]]
            for column in (to, ids, own):
                column[some], column[is_best] = column[is_best], column[some].copy()
        running = np.cumsum(whole(np.exp(own), 40))
        upto = (running - np.r_[0, running][first[begin]]) / 2**40
        upto[np.r_[begin[1:] != begin[:-1], True]] = 2.0  # the last edge of a place takes what is left
        base, edges = len(self.data), len(self.to)
        self.data = np.r_[self.data, data]
        self.starts, self.ends = np.r_[self.starts, (base + ends - sizes).astype(np.int32)], np.r_[self.ends, (base + ends).astype(np.int32)]
        self.first = np.r_[self.first, (edges + first).astype(np.int32)]
        self.to, self.id = np.r_[self.to, (base + to).astype(np.int32)], np.r_[self.id, ids.astype(np.int32)]
        self.own, self.upto = np.r_[self.own, np.minimum(own, 0)], np.r_[self.upto, upto.astype(np.float32)]

    def walk(self, chunks: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A sampled path through each chunk: all edges, one chunk after the other, the number of each, its log probability."""
        count = np.zeros(len(chunks), np.int64)
        log_p = np.zeros(len(chunks))
        which, at, end = np.arange(len(chunks)), self.starts.take(chunks), self.ends.take(chunks)
        seed, steps, step = seeds, [], 0
        while len(which):
            u = unit(seed, step).astype(np.float32)
            edge = self.first.take(at).astype(np.int64)  # a wide index is not converted each time it is used
            behind = np.flatnonzero(self.upto.take(edge) <= u)
            while len(behind):
                edge[behind] += 1
                behind = behind[self.upto.take(edge.take(behind)) <= u.take(behind)]
            steps.append((which, edge))
            # Every chunk has a first edge; those that go on are fewer.
            if step:
                count[which] += 1
                log_p[which] += self.own.take(edge)
            else:
                count += 1
                log_p += self.own.take(edge)
            at = self.to.take(edge)
            going = np.flatnonzero(at < end)
            which, at, end, seed, step = which.take(going), at.take(going), end.take(going), seed.take(going), step + 1
        place = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for step, (which, edge) in enumerate(steps):
            out[place.take(which) + step] = edge
        return out, count, log_p

    def leaving(self, chunk: int, taken: list[np.ndarray]) -> tuple[float, np.ndarray, list[tuple]]:
        """All ways to leave the paths taken through a chunk: the log mass of all together, the running sum of their shares,
        and the steps up to and with the leaving edge. Exact also where little is left."""
        follow: dict[tuple, set[int]] = {}
        for path in taken:
            path = tuple(path.tolist())
            for k, edge in enumerate(path):
                follow.setdefault(path[:k] if len(path) < 64 else (k, hash(path[:k])), set()).add(edge)
        ways, mass, seen = [], [], set()
        for path in taken:
            path, before, at = tuple(path.tolist()), 0.0, int(self.starts[chunk])
            for k, edge in enumerate(path):
                prefix = path[:k] if len(path) < 64 else (k, hash(path[:k]))
                if prefix not in seen:
                    seen.add(prefix)
                    for e in range(int(self.first[at]), int(self.first[at]) + self.degree(at)):
                        if e not in follow[prefix]:
                            ways.append((path, k, e))
                            mass.append(before + self.own[e])
                before, at = before + self.own[edge], int(self.to[edge])
        if not ways:
            return -np.inf, np.zeros(0), []
        mass = np.array(mass, float)
        share = np.exp(mass - mass.max())
        return float(mass.max() + np.log(share.sum())), np.cumsum(share), ways

    def degree(self, place: int) -> int:
        low = high = int(self.first[place])
        while self.upto[high] < 2.0:
            high += 1
        return high - low + 1

    def other(self, chunk: int, taken: list[np.ndarray], draws: random.Random) -> tuple[np.ndarray, float, float]:
        """A path through a chunk that is none of those taken, in proportion to its probability; that probability's log, and
        the log mass of what then is left."""
        mass, share, ways = self.leaving(chunk, taken)
        path, k, edge = ways[min(int(np.searchsorted(share, draws.random() * share[-1], "right")), len(ways) - 1)]
        found, at, end = [*path[:k], edge], int(self.to[edge]), int(self.ends[chunk])
        while at < end:
            u, edge = np.float32(draws.random()), int(self.first[at])
            while self.upto[edge] <= u:
                edge += 1
            found.append(edge)
            at = int(self.to[edge])
        new = np.array(found, np.int32)
        log_new = float(self.own[new].sum())
        left = -np.expm1(min(log_new - mass, 0.0))
        # The difference is exact enough unless little is left.
        return new, log_new, mass + np.log(left) if left > 1e-6 else self.leaving(chunk, [*taken, new])[0]

    def ids(self, path: np.ndarray) -> np.ndarray:
        """The ids of the pieces of a path; a character without a piece as its bytes."""
        return self.pieces(path)[0]

    def pieces(self, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of paths, one after the other, and how many ids each edge has."""
        ids = self.id.take(path)
        width = np.ones(len(ids), np.int64)
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids, width
        begin = np.searchsorted(self.first, path[bare], "right") - 1
        size = self.to[path[bare]] - begin
        width[bare] = size
        out = np.repeat(ids, width)
        out[out < 0] = self.words.byte_id[self.data[ranges(begin, size)]]
        return out, width


def whole(values: np.ndarray, bits: int) -> np.ndarray:
    """In units of 2**-bits: sums of whole numbers do not depend on what else is summed up before."""
    return np.rint(values * 2.0**bits).astype(np.int64)


def unit(seeds: np.ndarray, counter: int | np.ndarray) -> np.ndarray:
    """A number in (0, 1) for each seed and counter."""
    drawn = mix(seeds + np.asarray(counter).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), 5)
    return ((drawn >> np.uint64(12)).astype(np.float64) + 0.5) / 2**52


def below(limit: np.ndarray, mass: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The greatest Gumbel number of parts of these log masses, given that it is below the limit."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(np.isneginf(mass), -np.inf, mass - np.log(np.exp(mass - limit) - np.log(u)))


class Search:
    """The search over the lattice of one text. A part is (number, path, word, what is taken, the word's first edge in the path, log
    probability of the path before it): all that agree with the path up to the word and take nothing of `taken` there."""

    def __init__(self):
        self.queue: list[tuple] = []
        self.paths: list[np.ndarray] = []
        self.order = 0

    def push(self, number: float, path: int, word: int, taken: list) -> None:
        if number > -np.inf:
            heapq.heappush(self.queue, (-number, self.order, path, word, taken))
            self.order += 1


def chunks(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the chunks: spaces with what follows up to the next space, and every line end by itself."""
    data = block.data
    space, line = data == 32, data == 10
    new = line.copy()
    new[0:1] = True
    new[1:] |= (space[1:] & ~space[:-1]) | line[:-1]
    new[block.at[:-1][block.at[:-1] < len(data)]] = True
    starts = np.flatnonzero(new)
    return starts, np.r_[starts[1:], len(data)]


def sampled(block: Block, seeds: np.ndarray, store: Lattices, samples: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its segmentations: edges, log probability, perturbed, and probability of inclusion."""
    if not len(block.data):
        return [[(np.zeros(0, np.int32), 0.0, 0.0, 1.0)] for _ in range(len(block))]
    starts, ends = chunks(block)
    which = store.rows(block, block.pieces(starts, ends, EXACT), (starts, ends))
    first = np.searchsorted(starts, block.at)
    searches = [Search() for _ in range(len(block))]
    done: list[list] = [[] for _ in searches]
    roots = -np.log(-np.log(unit(seeds, 0)))
    # What each text expands in this round: number, mass and edges up to a word, and the words that are drawn anew.
    work = [(i, float(roots[i]), 0.0, np.zeros(0, np.int32), int(first[i])) for i in range(len(block)) if first[i + 1] > first[i]]
    for turn in range(samples):
        text = np.array([w[0] for w in work], np.int64)
        low, high = np.array([w[4] for w in work], np.int64), first[text + 1]
        sizes = high - low
        words = ranges(low, sizes)
        of = np.repeat(np.arange(len(work)), sizes)
        word_seed = mix(seeds[text][of] + (words - first[text][of] + 1).astype(np.uint64), 60 + turn)
        edges, counts, log_p = store.walk(which[words], word_seed)
        heads = np.cumsum(sizes) - sizes
        run = np.r_[0, np.cumsum(whole(log_p, 32))]
        start_mass = np.array([w[2] for w in work])
        prefix = (run[:-1] - run[heads][of]) / 2**32 + start_mass[of]
        number = np.array([w[1] for w in work])
        with np.errstate(divide="ignore"):
            rest = -np.expm1(np.minimum(log_p, 0.0))
            mass = np.where(rest > 0, prefix + np.log(np.maximum(rest, 1e-300)), -np.inf)
        numbers = below(number[of], mass, unit(word_seed, 1 << 40))
        cuts = np.r_[0, np.cumsum(counts)]
        ends_at = heads + sizes
        for k, (i, g, _, prefix_edges, _) in enumerate(work):
            a, b = int(heads[k]), int(ends_at[k])
            own = edges[cuts[a]:cuts[b]]
            leaf = float(start_mass[k] + (run[b] - run[a]) / 2**32)
            search = searches[i]
            done[i].append((np.concatenate([prefix_edges, own]), leaf, g))
            if a < b:  # only the best parts of a path can ever be popped
                some = numbers[a:b]
                keep = samples - turn
                best = np.argpartition(-some, keep - 1)[:keep] if len(some) > keep else np.arange(len(some))
                path = len(search.paths)
                search.paths.append(done[i][-1][0])
                for j in best.tolist():
                    at = len(prefix_edges) + int(cuts[a + j] - cuts[a])
                    taken = own[cuts[a + j] - cuts[a]:cuts[a + j + 1] - cuts[a]]
                    search.push(float(some[j]), path, int(words[a + j]), [taken, at, float(prefix[a + j])])
        if turn + 1 == samples:
            break
        work = []
        for i, search in enumerate(searches):
            if not search.queue:
                continue
            number, _, path, word, (*taken, at, before) = heapq.heappop(search.queue)
            g, chunk = -number, int(which[word])
            draws = random.Random(int(seeds[i]) ^ (int(word - first[i]) << 8 | turn))
            new, log_new, rest = store.other(chunk, taken, draws)
            # What is left at this word goes back with a number below that of what was popped.
            if rest > -np.inf:
                lower = before + rest - math.log(math.exp(before + rest - g) - math.log(draws.random()))
                search.push(lower, path, word, [*taken, new, at, before])
            work.append((i, g, before + log_new, np.concatenate([search.paths[path][:at], new]), word + 1))
        if not work:
            break
    out = []
    for i, search in enumerate(searches):
        limit = -search.queue[0][0] if search.queue else -np.inf
        found = done[i] or [(np.zeros(0, np.int32), 0.0, float(roots[i]))]
        out.append([(e, p, g, float(-np.expm1(-np.exp(min(p - limit, 50.0)))) if limit > -np.inf else 1.0) for e, p, g in found])
    return out


SCHEMA = "doc_id {id}, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, exact boolean"


def encode(documents: DataFrame, samples: int = 3, alpha: float = 1.0, model: str = MODEL, key: str = "doc_id") -> DataFrame:
    """The sampled segmentations of each row (key, text), best perturbed first: ids of the pieces, log probability, perturbed,
    probability of inclusion, and whether decoding gives the text again."""
    def step(block: Block, words: Vocabulary, store: Lattices) -> Iterator[pa.RecordBatch]:
        seeds = mix(block.rows.column("seed").to_numpy().view(np.uint64), 3)
        found = sampled(block, seeds, store, samples)
        flat = [(i, r, *x) for i, row in enumerate(found) for r, x in enumerate(row)]
        edges = [x[2] for x in flat]
        all_ids, width = store.pieces(np.concatenate(edges))
        cuts = np.cumsum([0, *map(len, edges)])
        sizes = np.diff(np.r_[0, np.cumsum(width)][cuts])
        of = np.array([x[0] for x in flat])
        # Decoded, and compared with the bytes of the texts one after the other.
        decoded, width = words.decode(all_ids), words.sizes[all_ids]
        length = np.add.reduceat(np.r_[width, 0], np.cumsum(sizes) - sizes) * (sizes > 0)
        wanted = np.diff(block.at)[of]
        same = length == wanted
        if same.all():
            differ = np.r_[0, np.cumsum(decoded != block.data[ranges(block.at[of], wanted)])]
            bounds = np.r_[0, np.cumsum(wanted)]
            same = differ[bounds[1:]] == differ[bounds[:-1]]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(all_ids))
        yield pa.RecordBatch.from_arrays(
            [block.rows.column("doc_id").take(pa.array(of)), pa.array([x[1] for x in flat], pa.int32()), lists,
             *(pa.array([float(x[c]) for x in flat], pa.float64()) for c in (3, 4, 5)), pa.array(same)],
            names=["doc_id", "sample", "ids", "log_prob", "perturbed", "inclusion", "exact"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        store = Lattices(words, alpha)
        for batch in batches:
            for block in blocks(batch, most=1 << 19):
                yield from step(block, words, store)

    bound_batches(documents.sparkSession)
    # The dummy prefix; a text of the mark itself stays apart from a space, as bytes. An empty text has no pieces.
    text = F.when(F.length("text") > 0, F.concat(F.lit(" "), F.col("text"))).otherwise("")
    rows = documents.select(F.col(key).alias("doc_id"), F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("seed"), text.alias("text"))
    return rows.mapInArrow(returning(run), SCHEMA.format(id=documents.schema[key].dataType.simpleString()))


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows with `text` from the ids of their pieces; ids that are null, or none, give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            texts = []
            for x in batch.column(ids):
                found = words.decode(x.values.to_numpy().astype(np.int64)).tobytes() if x.is_valid and len(x.values) else b""
                texts.append(found[1:] if found[:1] == b" " else found)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, "text"])
    bound_batches(rows.sparkSession)
    rows = rows.drop("text")
    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("text", T.StringType())]))
