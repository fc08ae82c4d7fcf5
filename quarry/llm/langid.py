"""Language identification: script ranges, per-word scores and a Viterbi path with a switching penalty.

Training counts hashed character bigrams and trigrams of words (with word ends) per language, and the
scripts a language is written in. A word's script narrows its candidate languages; its n-grams score
them. The best path over a text's words, paying a penalty for each switch, labels spans of languages.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_bytes

# Buckets of the hashed n-grams of each order, and the most cells of a model's table of either order: neighbouring
# buckets are added up where more languages than MODEL_CELLS / BUCKETS would go beyond it.
BUCKETS = 1 << 15
MODEL_CELLS = 200 * BUCKETS
# Most cells of the table of word scores over several texts; a longer text stands alone.
SCORE_CELLS = 8 << 20
# Languages whose counts a task holds at once.
HELD = 64
# Cost of a switch of language, in nats.
SWITCH = 12.0
# A language is a candidate for a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

# First and last code point of the blocks of each script; everything else is script 0.
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("gurmukhi", [(0xA00, 0xA7F)]),
    ("gujarati", [(0xA80, 0xAFF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("telugu", [(0xC00, 0xC7F)]),
    ("kannada", [(0xC80, 0xCFF)]),
    ("malayalam", [(0xD00, 0xD7F)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)]),
    ("ethiopic", [(0x1200, 0x139F)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]),
]


class Letters:
    """Tables over all code points: whether it is a letter, and its script."""

    def __init__(self) -> None:
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        self.script = np.zeros(sys.maxunicode + 1, np.uint8)
        for i, (_, ranges) in enumerate(SCRIPTS, 1):
            for lo, hi in ranges:
                self.script[lo:hi + 1] = i


@dataclass
class Words:
    """The words (runs of letters) of several texts, and the n-gram buckets at their letters and ends."""

    grams: tuple[np.ndarray, np.ndarray]  # bucket of the bigram and of the trigram at each position
    first: np.ndarray  # of each word: its first position in grams
    letters: np.ndarray
    script: np.ndarray
    per_text: np.ndarray  # words of each text


def words_of(texts: list[str], tables: Letters) -> Words:
    lowered = [t.lower() for t in texts]
    cps = np.frombuffer((" ".join(["", *lowered]) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = tables.is_letter[cps]
    z = np.where(letter, cps, 0).astype(np.uint64)
    at = np.flatnonzero(letter[1:] | letter[:-1]) + 1
    z0, z1 = z[at], z[at - 1]
    z2 = np.where(z1 == 0, np.uint64(0), z[np.maximum(at - 2, 0)])
    key = z0 * np.uint64(0x9E3779B97F4A7C15) + z1 * np.uint64(0xC2B2AE3D27D4EB4F)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    grams = tuple((((k ^ (k >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int32)
                  for k in (key, key + z2 * np.uint64(0x165667B19E3779F9)))
    first = np.flatnonzero(z1 == 0)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    text = np.searchsorted(ends, at[first], side="right") if len(first) else first
    sizes = np.diff(np.append(first, len(at)))
    return Words(grams, first, sizes - 1, tables.script[cps[at[first]]], np.bincount(text, minlength=len(texts)))


def counts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, feature, n``: bigram buckets, then trigram buckets, then scripts (their letters)."""
    size = 2 * BUCKETS + len(SCRIPTS) + 1

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, total = Letters(), defaultdict(lambda: np.zeros(size, np.int64))
        for batch in batches:
            for part in by_bytes(batch, "__text"):
                by_lang = defaultdict(list)
                for lang, text in zip(part.column("__lang").to_pylist(), part.column("__text").to_pylist(), strict=True):
                    by_lang[lang].append(text)
                for lang, texts in by_lang.items():
                    w = words_of(texts, tables)
                    found = np.concatenate([np.bincount(w.grams[0], minlength=BUCKETS), np.bincount(w.grams[1], minlength=BUCKETS),
                                            np.bincount(w.script, weights=w.letters, minlength=len(SCRIPTS) + 1).astype(np.int64)])
                    total[lang] += found
                    if len(total) >= HELD:
                        yield from rows(total)
                        total.clear()
        yield from rows(total)

    def rows(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in total.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)),
                                              pa.array(n[seen])], names=["lang", "feature", "n"])

    source = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("__lang"), F.col(text_col).alias("__text"))
    return source.mapInArrow(kernel, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray  # (2, languages, buckets)
    allowed: np.ndarray  # (scripts, languages)


def fold_of(n_langs: int) -> int:
    """How many times buckets are halved, so that the tables of this many languages stay within MODEL_CELLS."""
    return min(max(0, math.ceil(math.log2(max(1, n_langs * BUCKETS / MODEL_CELLS)))), BUCKETS.bit_length() - 1)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on every given row, for any number of languages; the driver gets at most 2 * MODEL_CELLS counts."""
    found = counts(df, text_col, lang_col).cache()
    langs = sorted(r.lang for r in found.select("lang").distinct().collect())
    fold = fold_of(len(langs))
    buckets = BUCKETS >> fold
    # a bigram's bucket, a trigram's (behind BUCKETS) and a script keep their order when buckets are halved
    feature = F.when(F.col("feature") < 2 * BUCKETS, F.shiftright("feature", fold)).otherwise(
        F.col("feature") - 2 * BUCKETS + 2 * buckets)
    rows = found.groupBy("lang", feature.alias("feature")).agg(F.sum("n").alias("n")).toArrow()
    found.unpersist()
    n = np.zeros((len(langs), 2 * buckets + len(SCRIPTS) + 1))
    index = {lang: i for i, lang in enumerate(langs)}
    n[[index[x] for x in rows["lang"].to_pylist()], rows["feature"].to_numpy()] = rows["n"].to_numpy()
    grams = n[:, :2 * buckets].reshape(len(langs), 2, buckets) + 0.5
    log_p = np.log(grams / grams.sum(axis=2, keepdims=True)).transpose(1, 0, 2) / 2
    scripts = n[:, 2 * buckets:]
    allowed = scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True), 1)
    return Model(langs, log_p.astype(np.float32), allowed.T)


def word_scores(w: Words, model: Model) -> np.ndarray:
    """(words, languages): log score of each word, -1000 where its script rules a language out."""
    out = np.zeros((len(w.first), len(model.langs)))
    if not len(w.first):
        return out
    fold = (BUCKETS // model.log_p.shape[2]).bit_length() - 1
    two, three = (g >> fold for g in w.grams)
    for i in range(len(model.langs)):
        out[:, i] = np.add.reduceat(model.log_p[0, i][two] + model.log_p[1, i][three], w.first)
    allowed = model.allowed[w.script]
    known = allowed.any(axis=1)
    return np.where(known[:, None], np.where(allowed, out, -1000.0), 0.0)


def best_paths(scores: np.ndarray, per_text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of every word on the best path of its text; words of a text are neighbours.

    A text keeps its best single language throughout if no run of words favours another one over it by
    more than half the penalty: k stretches in other languages then gain at most k halves and need k
    switches, or k - 1 >= k / 2 if they make up the whole text. Only the other texts are walked word by
    word, all of them at once.
    """
    path = np.zeros(len(scores), np.int64)
    texts = np.flatnonzero(per_text)
    if not len(texts) or scores.shape[1] < 2:
        return path
    n = per_text[texts]
    start = np.cumsum(n) - n
    best = np.argmax(np.add.reduceat(scores, start, axis=0), axis=1)
    of_word = np.repeat(np.arange(len(texts)), n)
    path[:] = best[of_word]
    gain = np.zeros(len(texts))
    for s in range(scores.shape[1]):
        ahead = scores[:, s] - scores[np.arange(len(scores)), path]
        total = np.cumsum(ahead)
        before = total - ahead
        fall = (np.abs(ahead).sum() + 1) * of_word  # each text starts below all that came before
        low = np.minimum.accumulate(before - fall) + fall
        gain = np.maximum(gain, np.maximum.reduceat(total - low, start))
    mixed = np.flatnonzero(gain > switch / 2 - 1e-3)
    mixed = mixed[np.argsort(-n[mixed], kind="stable")]
    if not len(mixed):
        return path
    first, steps = start[mixed], n[mixed]
    came = np.zeros(scores.shape, np.min_scalar_type(scores.shape[1]))
    reach = scores[first].copy()
    live = np.searchsorted(-steps, -np.arange(1, steps[0]), side="left")  # texts longer than t words
    for t in range(1, steps[0]):
        k = live[t - 1]
        old, rows = reach[:k], np.arange(k)
        top = old.argmax(axis=1)
        jump = old[rows, top] - switch
        stays = old >= jump[:, None]
        came[first[:k] + t] = np.where(stays, np.arange(old.shape[1]), top[:, None])
        reach[:k] = scores[first[:k] + t] + np.where(stays, old, jump[:, None])
    state = reach.argmax(axis=1)
    for t in range(steps[0] - 1, -1, -1):
        k = live[t - 1] if t else len(mixed)
        path[first[:k] + t] = state[:k]
        if t:
            state[:k] = came[first[:k] + t, state[:k]]
    return path


def predict(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``lang_pred``, ``score`` and ``spans`` of each whole text.

    ``lang_pred`` has most letters on the best path, the first by name in a tie; ``score`` is its share of
    letters. ``spans`` lists first word, last word and language. A null text, one without letters, and
    every text if nothing was learned, gets ``und``, 0 and no spans. Rows are judged one by one, so
    repeated rows, null keys and further columns do not matter; an empty table gives an empty result.
    """
    keep = list(keep)
    source = df.select(*keep, df[text_col].alias("__text"))
    # bounded by MODEL_CELLS; plain values, as executors may lack this package
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.log_p, model.allowed))
    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, m = Letters(), Model(*shared.value)
        limit = min(4 << 20, SCORE_CELLS * 6 // max(1, len(m.langs)))  # a word takes about six bytes
        for batch in batches:
            for part in by_bytes(batch, "__text", limit):
                texts = [t or "" for t in part.column("__text").to_pylist()]
                w = words_of(texts, tables)
                langs, scores, spans = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
                if m.langs and len(w.first):
                    path = best_paths(word_scores(w, m), w.per_text)
                    text = np.repeat(np.arange(len(texts)), w.per_text)
                    share = np.zeros((len(texts), len(m.langs)))
                    np.add.at(share, (text, path), w.letters)
                    top, total = share.argmax(axis=1), share.sum(axis=1)
                    edge = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (path[1:] != path[:-1])))
                    offset = np.cumsum(w.per_text) - w.per_text
                    for a, b in zip(edge.tolist(), np.append(edge[1:], len(path)).tolist(), strict=True):
                        i = int(text[a])
                        spans[i].append({"first": a - int(offset[i]), "last": b - 1 - int(offset[i]), "lang": m.langs[path[a]]})
                    for i in np.flatnonzero(total).tolist():
                        langs[i], scores[i] = m.langs[top[i]], float(share[i, top[i]] / total[i])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(langs), pa.array(scores, pa.float64()), pa.array(spans, span)],
                    names=[*keep, "lang_pred", "score", "spans"])

    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(kernel, f"{schema + ', ' if keep else ''}lang_pred string, score double, "
                                     "spans array<struct<first: int, last: int, lang: string>>")


def held_out(key: str = "doc_id"):
    """Whether a document is kept from learning: its key's crc32 leaves 1 when divided by 3 (a null key: no)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
