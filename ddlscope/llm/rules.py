"""Counts on whole texts that quality rules and classifiers share."""

from __future__ import annotations

import numpy as np

from ddlscope.llm.texts import EXACT, FIRST_BYTE, NEWLINE, SPACE, SYMBOL, Block


def per_row(block: Block, rows: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, values, len(block)).astype(np.int64)


def repeated(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which items occur twice or more in their row, and which are equal to an earlier one."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    same = np.zeros(len(r) + 1, bool)
    same[1:-1] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    twice, later = np.zeros(len(r), bool), np.zeros(len(r), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]  # the sort is stable, so the first of equals stands first
    return twice, later


def word_chars(block: Block) -> np.ndarray:
    return block.counted(FIRST_BYTE & ~SPACE)


def symbols(block: Block) -> np.ndarray:
    return block.counted(SYMBOL)


def duplicate_lines(block: Block, sums: np.ndarray) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of the text."""
    starts, ends = block.between(NEWLINE)  # empty lines have no word
    words = np.r_[0, np.cumsum(~SPACE[block.data])]
    full = words[ends] > words[starts]
    starts, ends = starts[full], ends[full]
    rows = block.row_of(starts)
    return per_row(block, rows[repeated(rows, block.pieces(starts, ends, EXACT, sums))[1]])


def repeat_words(block: Block, words: np.ndarray, size: int = 5) -> np.ndarray:
    """Words within windows that occur twice or more in the text."""
    begins, hashes = block.windows(words, size)
    covered = covering(begins[repeated(block.row[begins], hashes)[0]], size, len(words))
    return per_row(block, block.row[covered])


def covering(begins: np.ndarray, size: int, words: int) -> np.ndarray:
    """Whether each word lies in one of the windows that begin there."""
    edges = np.zeros(words + 1, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + size, -1)
    return np.cumsum(edges[:-1]) > 0
