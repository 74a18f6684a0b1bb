import random
from collections import defaultdict

import numpy as np
import pytest
from ddlscope.llm import groups, queries, superminhash
from tests.conftest import SMALL
from tests.llm.tables import WORD, awkward, documents, empty, equal_polynomials, prose


def brute(rows, size, percent):
    """Id, size of the set, component and kept of each row, links by all pairs of sets."""
    sets, root = [], list(range(len(rows)))
    for _, text in rows:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set()))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if None not in (rows[a][0], rows[b][0]) and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[find(a)] = find(b)
    least = defaultdict(lambda: float("inf"))
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least[find(i)], doc)
    return sorted(((doc, len(s), None if doc is None else least[find(i)], doc is None or doc == least[find(i)])
                   for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def found(rows, **more):
    return sorted((tuple(r) for r in superminhash.near_duplicates(rows, **more).collect()), key=str)


def edited(words, seed, edits):
    rng, words = random.Random(seed), list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("size, percent", [(4, 80), (5, 80), (1, 60)])
def test_equals_brute_force(spark, size, percent):
    base, other = prose(71, 120, 9000).split(" "), prose(72, 60, 9000).split(" ")
    rows = awkward() + [(1000 + i, edited(base, i, 1 + i % 7)) for i in range(70)] + [(2000 + i, edited(base + other, i, i % 9)) for i in range(40)]
    random.Random(3).shuffle(rows)
    assert found(documents(spark, rows), size=size, percent=percent) == brute(rows, size, percent)


def test_tiles_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(superminhash, "TILE", 7)
    base = prose(81, 130, 9000).split(" ")
    rows = [(i, edited(base, i, 2 + i % 6)) for i in range(120)]
    assert found(documents(spark, rows), size=4, percent=80) == brute(rows, 4, 80)


def test_signature_is_that_of_one_element_at_a_time():
    rng = np.random.default_rng(9)
    rows = np.sort(rng.integers(0, 6, 400))
    hashes = rng.integers(0, 2**63, 400, np.uint64)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    slots = 24
    got = superminhash.signatures(rows, hashes, 8, slots)
    for text in range(8):
        want = [2**64 - 1] * slots
        for h in hashes[rows == text]:
            h, places = np.array([h], np.uint64), list(range(slots))
            for rank in range(slots):
                k = rank + int(superminhash.mix(h, 2 * rank)[0] % np.uint64(slots - rank))
                value = rank << 56 | int(superminhash.mix(h, 2 * rank + 1)[0]) >> 8
                want[places[k]] = min(want[places[k]], value)
                places[k], places[rank] = places[rank], places[k]
        assert got[text].tolist() == want


def test_signature_estimates_similarity():
    rng = np.random.default_rng(10)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 2**63, 300, np.uint64)
        b = np.r_[a[:200], rng.integers(0, 2**63, 100, np.uint64)]
        signed = superminhash.signatures(np.repeat([0, 1], 300), np.r_[np.sort(a), np.sort(b)], 2)
        errors.append((signed[0] == signed[1]).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(500, 400), (450, 400), (450, 449)] + [(1000, 2000 + i) for i in range(300)]
    rng.shuffle(links)
    got = dict(map(tuple, groups.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()))
    assert got == {**{i: 0 for i in range(1, 301)}, 500: 400, 450: 400, 449: 400, **{2000 + i: 1000 for i in range(300)}}
    assert groups.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_no_rows(spark):
    assert found(empty(spark)) == []


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op10_superminhash"](spark, SMALL).collect()), key=str) == brute(rows, 4, 80)


def test_texts_that_share_an_id(spark):
    rng = random.Random(8)
    one, two = prose(301, 120, 9000).split(" "), prose(302, 120, 9000).split(" ")
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, edited(one, 1, 2)), (4, edited(one, 2, 2)), (3, edited(two, 3, 2)), (5, edited(two, 4, 2))]
    rows += [(0, "x y z a b"), (1, "x y z a b"), (1, prose(303, 40))] + [(7, prose(400 + i, 30)) for i in range(5)]
    for _ in range(3):
        rng.shuffle(rows)
        assert found(documents(spark, rows), size=4, percent=80) == brute(rows, 4, 80)
    stay = {(r["doc_id"], r["component_id"]) for r in superminhash.grouped(documents(spark, rows), 4, 80).collect() if r["stays"]}
    assert stay == {(1, 1), (0, 0), (7, 7)}
    assert superminhash.grouped(documents(spark, rows), 4, 80).filter("stays").count() == 2 + 1 + 1 + 5


def test_tiles_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(superminhash, "TILE_BYTES", 2000)
    base = prose(81, 130, 9000).split(" ")
    rows = [(i, edited(base, i, 2 + i % 6)) for i in range(60)]
    assert found(documents(spark, rows), size=4, percent=80) == brute(rows, 4, 80)


@pytest.mark.parametrize("letters", [1024, 8192])
def test_written_strings_do_not_clash(spark, letters):
    one, other = equal_polynomials(letters)
    rows = [(1, one), (2, other), (3, f"{one} x"), (4, f"{other} x"), (5, one.upper())]
    assert found(documents(spark, rows), size=4, percent=80) == brute(rows, 4, 80)
