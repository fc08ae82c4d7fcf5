"""Quality rules by repetition coverage.

For several n-gram lengths a rolling hash runs over the word ids of a text, in numpy, for many texts at
once. Windows whose hash occurs twice or more in the same text are duplicated n-grams; the rule measures
the characters of all words inside them, and the characters of lines that repeat an earlier line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import SPACES, WORD, by_bytes

BASE_N = 5
# Largest allowed percentage of a text's word characters inside duplicated n-grams, by n.
NGRAM_LIMITS = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
# Largest allowed percentage of line characters that repeat an earlier line.
LINE_CHAR_LIMIT = 30
# Largest allowed percentage of words that equal the word before them (1-grams repeated at once).
STUTTER_LIMIT = 20
# Largest allowed number of symbols per hundred words.
SYMBOL_LIMIT = 20
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 10, 20

COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
           "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "n_lines": pa.int64(),
           "dup_line_chars": pa.int64(), "line_chars": pa.int64(), "n_stutter": pa.int64(), "dup_ngram_chars": pa.list_(pa.int64())}
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "kept boolean, n_lines long, dup_line_chars long, line_chars long, n_stutter long, dup_ngram_chars array<long>")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads small ids over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(at: np.ndarray, keys: np.ndarray, ids: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Those window starts ``at`` whose n words occur at another start of the same text as well.

    Equal hashes are checked word by word; if a collision shows, the windows are grouped by their words.
    """
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    true = doc[a] == doc[b]
    for k in range(n):
        true &= ids[a + k] == ids[b + k]
    if not true.all():
        rows = np.column_stack([doc[at], *(ids[at + k] for k in range(n))])
        _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        return at[counts[inverse.reshape(-1)] > 1]
    hit = np.zeros(len(at), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return at[hit]


def coverage(words: list[list[str]], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text and n: words, and characters of words, inside n-grams found twice or more in that text.

    Third: per text, the words that equal the word before them.
    ``lengths`` ascends by one: an n-gram can only repeat where the shorter one starting there does.
    """
    vocab: dict[str, int] = {}
    counts = np.array([len(w) for w in words], np.int64)
    ids = np.array([vocab.setdefault(w, len(vocab)) for text in words for w in text], np.int64)
    chars = np.array([len(w) for w in vocab], np.int64)[ids] if len(ids) else ids
    doc = np.repeat(np.arange(len(words)), counts)
    end = np.cumsum(counts)[doc] if len(ids) else ids
    hashed = mix(ids.astype(np.uint64) + np.uint64(1))
    base = np.uint64(0x9E3779B97F4A7C15)
    covered_words = np.zeros((len(words), len(lengths)), np.int64)
    covered_chars = np.zeros_like(covered_words)
    at = np.arange(len(ids))
    keys, width = mix(doc.astype(np.uint64) + base), 0
    for j, n in enumerate(lengths):
        fits = at + n <= end[at]
        at, keys = at[fits], keys[fits]
        while width < n:  # roll the hash on by one word
            keys = keys * base + hashed[at + width]
            width += 1
        found = repeated(at, keys, ids, doc, n)
        keys, at = keys[np.isin(at, found, assume_unique=True)], found if np.all(found[1:] > found[:-1]) else np.sort(found)
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        inside = np.cumsum(edge[:-1]) > 0
        covered_words[:, j] = np.bincount(doc[inside], minlength=len(words))
        covered_chars[:, j] = np.bincount(doc[inside], weights=chars[inside], minlength=len(words))
    stutter = np.bincount(doc[1:][(ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])], minlength=len(words))
    return covered_words, covered_chars, stutter


def line_repeats(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, those equal to an earlier one, and the characters of either."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    first = set(lines)
    if len(first) == len(lines):
        return len(lines), 0, sum(map(len, lines)), 0
    return len(lines), len(lines) - len(first), (total := sum(map(len, lines))), total - sum(map(len, first))


def quality_rules(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus the measures and verdicts of each row's whole text.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in repeated 5-word windows.
    ``kept``: not base_failed, and within every limit of duplicated n-gram characters, repeated lines, words
    repeated at once and symbols. ``dup_ngram_chars`` has one entry for each n of NGRAM_LIMITS. A null text has no words and
    fails the base rule, as does an empty one. Rows are judged one by one, so ties, repeated rows, null
    keys and further columns do not matter; an empty table gives an empty result.
    """
    keep, lengths = list(keep), sorted(NGRAM_LIMITS)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(WORD)
        for batch in batches:
            for part in by_bytes(batch, "__text"):
                texts = [t or "" for t in part.column("__text").to_pylist()]
                words = [word.findall(t) for t in texts]
                in_words, in_chars, stutter = coverage(words, lengths)
                rows = []
                for i, (text, found) in enumerate(zip(texts, words, strict=True)):
                    n, symbols = len(found), sum(map(text.count, SYMBOLS))
                    chars = len(text) - sum(map(text.count, SPACES))
                    n_lines, dup_lines, line_chars, dup_chars = line_repeats(text)
                    again = int(in_words[i, lengths.index(BASE_N)])
                    failed = n < MIN_WORDS or 100 * again > MAX_REPEAT * n
                    kept = (not failed and 100 * symbols <= SYMBOL_LIMIT * n
                            and 100 * int(stutter[i]) <= STUTTER_LIMIT * n
                            and 100 * dup_chars <= LINE_CHAR_LIMIT * line_chars
                            and all(100 * int(c) <= NGRAM_LIMITS[k] * chars for c, k in zip(in_chars[i], lengths, strict=True)))
                    rows.append((n, chars, symbols, dup_lines, again, failed, kept, n_lines, dup_chars, line_chars,
                                 int(stutter[i]), in_chars[i].tolist()))
                made = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *(pa.array(v, t) for v, t in zip(made, COLUMNS.values(), strict=True))],
                    names=[*keep, *COLUMNS])

    source = df.select(*keep, df[text_col].alias("__text"))
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(kernel, f"{schema + ', ' if keep else ''}{SCHEMA}")
