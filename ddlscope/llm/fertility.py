"""Quality rules on how well public vocabularies fit a text.

Each word is encoded as it stands after a space; the measures of a text are the characters per token in each vocabulary, the
share of tokens that are byte fallbacks, and the entropy of its tokens as a share of the most that as many tokens can have.
That share falls as a text grows, since entropy ends at that of the words in use. So the verdict goes by the mean share of
consecutive stretches of up to `STRETCH` tokens that cover the text; up to one stretch both are the same.
A text is rejected when a measure lies outside the band of its language. Repetitive texts have low entropy, texts full of
symbols or in capitals few characters per token, texts in scripts that the vocabulary lacks many fallbacks.

Tokens are worked out once for each distinct word in a task, whose number is bounded: the store begins anew when it is full.

Defined cases: a null or empty text has no measures (null) and fails the base rule; a short one is not judged by measures; where the language has no
band, or is null, the script of the text has one, and the widest band holds for other scripts; repeated rows and null ids are rows like others; extra columns are not read."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ddlscope.llm import rules
from ddlscope.llm.texts import EXACT, Block, Store, blocks, bound_batches, ranges, returning

VOCABULARIES = "/opt/tokenizers"
PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
#: The word pattern of the rank file does not matter to single words but for letters, digits and the rest being apart.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A text of fewer tokens has measures, but too uncertain for a verdict on them, and no entropy.
SHORT = 32
#: Tokens in a stretch of which the entropy is taken; a longer text is cut into equal stretches.
STRETCH = 8192


@dataclass(frozen=True)
class Band:
    """What is accepted: characters per token of both vocabularies, fallback share, entropy share of stretches."""

    piece_low: float
    piece_high: float
    rank_low: float
    rank_high: float
    fallback_high: float
    entropy_low: float


#: No limit of it is stricter than that of a named language.
WIDEST = Band(1.0, 12.0, 1.0, 12.0, 0.5, 0.42)
BANDS = {"en": Band(1.6, 7.0, 1.85, 8.0, 0.05, 0.42), "de": Band(1.6, 7.0, 1.85, 8.0, 0.05, 0.42),
         "fr": Band(1.5, 7.0, 1.72, 8.0, 0.05, 0.42), "es": Band(1.4, 7.0, 1.68, 8.0, 0.05, 0.42)}


# Scripts of which the vocabularies know characters and few words, and those that they mostly spell in bytes: a token is
# about a character or less, and the distinct ones are few.
CHARACTERS, MARKED, SPELT = Band(0.4, 12.0, 0.4, 12.0, 0.5, 0.25), Band(0.45, 12.0, 0.4, 12.0, 0.5, 0.25), Band(0.25, 12.0, 0.25, 12.0, 1.0, 0.2)
#: First and last code point of letters, and the band; ranges of one band count together, letters in none as another script.
SCRIPTS = (
    (0x0370, 0x03FF, MARKED), (0x1F00, 0x1FFF, MARKED),  # Greek
    (0x0530, 0x058F, MARKED), (0x0590, 0x05FF, MARKED),  # Armenian, Hebrew
    (0x0600, 0x06FF, MARKED), (0x0750, 0x077F, MARKED), (0x08A0, 0x08FF, MARKED), (0xFB1D, 0xFDFF, MARKED), (0xFE70, 0xFEFE, MARKED),  # Arabic
    (0x0700, 0x074F, SPELT), (0x0780, 0x085F, SPELT),  # Syriac, Thaana, N'Ko, Samaritan, Mandaic
    (0x0900, 0x0DFF, SPELT),  # Devanagari, Bengali and the others of India, Sinhala
    (0x0E00, 0x109F, SPELT),  # Thai, Lao, Tibetan, Myanmar
    (0x10A0, 0x10FF, SPELT), (0x1200, 0x139F, SPELT), (0x1780, 0x18AF, SPELT), (0x2D80, 0x2DDF, SPELT),  # Georgian, Ethiopic, Khmer, Mongolian
    (0x1100, 0x11FF, CHARACTERS), (0x3130, 0x318F, CHARACTERS), (0xAC00, 0xD7FF, CHARACTERS),  # Hangul
    (0x2E80, 0x2FDF, CHARACTERS), (0x3005, 0x3007, CHARACTERS), (0x3040, 0x312F, CHARACTERS), (0x31A0, 0x9FFF, CHARACTERS),  # Han, Kana
    (0xF900, 0xFAFF, CHARACTERS), (0xFF66, 0xFF9F, CHARACTERS), (0x20000, 0x3FFFF, CHARACTERS))
#: A text is in a script from this share of its letters on: beside so many, the tokens of other letters do not make up for it.
IN_SCRIPT = 0.25


def band_by_script(text: bytes, widest: Band) -> Band:
    """The band of the script that most letters of the text are in, if they are enough."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    letters = np.count_nonzero(((points | 32) - 97 < 26) | ((points >= 0xAA) & ((points < 0x2000) | (points > 0x206F))))
    beyond = np.sort(points[points >= SCRIPTS[0][0]])
    counts = dict.fromkeys((band for _, _, band in SCRIPTS), 0)
    for low, high, band in SCRIPTS:
        counts[band] += int(np.searchsorted(beyond, high, "right") - np.searchsorted(beyond, low))
    best = max(counts, key=counts.get)
    return best if counts[best] and counts[best] >= IN_SCRIPT * letters else widest


class Tokens(Store):
    """Tokens of the distinct words that a task has met."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        with open(f"{folder}/{RANKS}", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        super().__init__()

    def clear(self) -> None:
        super().clear()
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)
        self.n_fallback = self.n_ranks = np.zeros(0, np.int64)

    def add(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        ids = self.pieces.encode(texts, num_threads=1)  # the dummy prefix stands for the space
        flat = np.fromiter((x for w in ids for x in w), np.int32)
        bounds = np.r_[0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]
        fallback = np.diff(np.r_[0, np.cumsum(self.is_byte[flat])][bounds])
        self.ids, self.ends = np.r_[self.ids, flat], np.r_[self.ends, self.ends[-1] + bounds[1:]]
        self.n_fallback = np.r_[self.n_fallback, fallback]
        self.n_ranks = np.r_[self.n_ranks, [len(self.ranks.encode_ordinary(" " + t)) for t in texts]]


def entropy_share(ids: np.ndarray) -> float:
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    return -(p * np.log2(p)).sum() / np.log2(len(ids))


def entropy_shares(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The share of each whole text, and the mean share of its stretches."""
    whole, stretched = np.full((2, len(ends) - 1), np.nan)
    for i, (low, high) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        if high - low >= SHORT:
            whole[i] = stretched[i] = entropy_share(ids[low:high])
            if high - low > STRETCH:
                parts = -(-(high - low) // STRETCH)
                stretched[i] = np.mean([entropy_share(x) for x in np.array_split(ids[low:high], parts)])
    return whole, stretched


SCHEMA = ("doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, chars_per_piece double, chars_per_rank double, fallback_share double, entropy_share double, "
          "stretch_entropy_share double")


def judge(documents: DataFrame, folder: str = VOCABULARIES, bands: dict[str, Band] = BANDS, widest: Band = WIDEST) -> DataFrame:
    """The base counts, the measures and the verdict for each row of `documents` (doc_id, lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = None
        for batch in batches:
            for block in blocks(batch):
                store = store or Tokens(folder)
                yield measure(block, store, bands, widest)

    bound_batches(documents.sparkSession)
    rows = documents.select("doc_id", "lang", "text")
    return rows.mapInArrow(returning(run), SCHEMA.format(id=documents.schema["doc_id"].dataType.simpleString()))


def measure(block: Block, store: Tokens, bands: dict[str, Band], widest: Band) -> pa.RecordBatch:
    sums = block.sums(EXACT)
    words = block.pieces(*block.bounds, EXACT, sums)
    n, chars = block.n_words, rules.word_chars(block)
    repeats = rules.repeat_words(block, words)
    failed = (n < 10) | (100 * repeats > 20 * n)
    codes = store.rows(block, words)
    sizes = np.diff(store.ends)[codes]
    tokens, by_rank, fallback = (rules.per_row(block, block.row, v[codes]) for v in (np.diff(store.ends), store.n_ranks, store.n_fallback))
    ids = store.ids[ranges(store.ends[codes], sizes)]
    entropy, stretched = entropy_shares(ids, np.r_[0, np.cumsum(tokens)])
    with np.errstate(divide="ignore", invalid="ignore"):
        per_piece, per_rank, fallbacks = chars / tokens, chars / by_rank, fallback / tokens
    langs = block.rows.column("lang").to_pylist()
    chosen = [bands[x] if x in bands else band_by_script(block.text(i), widest) for i, x in enumerate(langs)]
    limits = np.array([[getattr(b, f) for f in Band.__dataclass_fields__] for b in chosen])
    with np.errstate(invalid="ignore"):
        outside = ((per_piece < limits[:, 0]) | (per_piece > limits[:, 1]) | (per_rank < limits[:, 2]) | (per_rank > limits[:, 3])
                   | (fallbacks > limits[:, 4]) | (stretched < limits[:, 5]))
    floats = [pa.array(x, pa.float64(), from_pandas=True) for x in (per_piece, per_rank, fallbacks, entropy, stretched)]
    counts = [pa.array(x, pa.int64()) for x in (n, chars, rules.symbols(block), rules.duplicate_lines(block, sums), repeats)]
    return pa.RecordBatch.from_arrays(
        [block.rows.column("doc_id"), *counts, pa.array(failed), pa.array(~failed & ~(outside & (tokens >= SHORT))), *floats],
        names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
               "chars_per_piece", "chars_per_rank", "fallback_share", "entropy_share", "stretch_entropy_share"])
