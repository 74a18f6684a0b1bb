import numpy as np
import pyarrow as pa
import pytest

from ddlscope.llm import rules
from ddlscope.llm.texts import EXACT, FOLDED, blocks, ranges
from tests.llm.tables import WORD, awkward


def one_block(texts):
    return next(blocks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]), most=1 << 30))


@pytest.mark.parametrize("most", [1, 3000, 1 << 30])
def test_words_are_those_of_the_pattern(most):
    texts = [t for _, t in awkward()]
    found = []
    for block in blocks(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]), most=most):
        words = [block.data[a:b].tobytes().decode() for a, b in zip(*block.bounds)]
        found += [words[a:b] for a, b in zip(block.first[:-1], block.first[1:])]
    assert found == [WORD.findall(t or "") for t in texts]


def test_a_sliced_batch_has_its_own_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "c", "d e f"])], names=["text"]).slice(1, 3)
    assert next(blocks(batch)).n_words.tolist() == [0, 1, 3]


def test_equal_words_and_only_those_have_equal_hashes():
    block = one_block(["ab Ab ba ab", "ab", "b a b"])
    words = [block.data[a:b].tobytes() for a, b in zip(*block.bounds)]
    for table, fold in ((EXACT, bytes), (FOLDED, bytes.lower)):
        hashes = block.words(table).tolist()
        assert [[x == y for y in hashes] for x in hashes] == [[fold(x) == fold(y) for y in words] for x in words]


def test_windows_stay_within_a_text():
    block = one_block(["a b c d", "b c", "", "b c d"])
    begins, hashes = block.windows(block.words(), 3)
    assert block.row[begins].tolist() == [0, 0, 3] and hashes[1] == hashes[2] != hashes[0]


def test_counts_of_rules():
    block = one_block(["#a\nx y\n\nx y\nx y", "%&|<>*$", "a b c d e a b c d e f", ""])
    assert rules.symbols(block).tolist() == [1, 7, 0, 0]
    assert rules.duplicate_lines(block, block.sums(EXACT)).tolist() == [2, 0, 0, 0]
    assert rules.repeat_words(block, block.words()).tolist() == [0, 0, 10, 0]


def test_ranges():
    assert ranges(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
