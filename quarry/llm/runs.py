"""Periodic runs of words by a suffix automaton with link-cut access.

The suffix automaton of a word sequence has a tree of suffix links in which the path from a prefix to the
root holds all its suffixes. Appending word i makes an access: the path of prefix i is recoloured with i,
the last end of all these suffixes. Before that the path falls into segments of one colour e each, the
previous end of the suffixes in it, and the longest suffix of a segment, of ``n`` words, says that the last
``n`` words also stand ``q = i - e`` words earlier. With n >= q that is a square, and the n + q words that end
at i have the smallest period q and cannot be extended to the left. The last i at which this start and
period show is the end of the run.

The automaton is complete before the first access, so the tree keeps its shape and preferred paths need no
splay trees: each heavy path of the tree keeps its coloured segments as a stack, the nearest to the root on
top; an access pops what it recolours and pushes one segment, O(log n) amortised for each word.

A run of at least ``MIN_RUN`` words and ``MIN_PERIODS`` periods repeats each of its three-word sequences at least
three times. Words that lie in no four adjacent sequences of that kind are in no run, and the automaton is
built for the stretches between them only; every run lies in one stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_bytes

# A run has at least that many words and that many periods.
MIN_RUN, MIN_PERIODS = 6, 4
SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
COLUMNS = {"n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
           "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and longest lengths of the states, and the state of every prefix; state 0 is the root.

    Most states have one way on, kept in two lists; only further ways cost a dictionary.
    """
    link, size, first, to, more = [-1], [0], [-1], [-1], [None]
    prefixes, last = [], 0
    for w in words:
        new = len(size)
        link.append(0)
        size.append(size[last] + 1)
        first.append(-1)
        to.append(-1)
        more.append(None)
        p = last
        q = -1
        while p >= 0:
            if first[p] == w:
                q = to[p]
                break
            if first[p] < 0:
                first[p], to[p] = w, new
            else:
                ways = more[p]
                if ways is None:
                    more[p] = {w: new}
                else:
                    q = ways.get(w, -1)
                    if q >= 0:
                        break
                    ways[w] = new
            p = link[p]
        if q >= 0:
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                clone = len(size)
                link.append(link[q])
                size.append(size[p] + 1)
                first.append(first[q])
                to.append(to[q])
                more.append(None if more[q] is None else dict(more[q]))
                while p >= 0:
                    if first[p] == w:
                        if to[p] != q:
                            break
                        to[p] = clone
                    else:
                        ways = more[p]
                        if ways is None or ways.get(w, -1) != q:
                            break
                        ways[w] = clone
                    p = link[p]
                link[q] = link[new] = clone
        prefixes.append(new)
        last = new
    return link, size, prefixes


def heavy_paths(link: list[int], size: list[int]) -> list[int]:
    """For every state the top state of its heavy path."""
    order = np.argsort(np.array(size), kind="stable").tolist()
    below = [1] * len(link)
    for v in reversed(order[1:]):
        below[link[v]] += below[v]
    heavy, most = [-1] * len(link), [0] * len(link)
    for v in order[1:]:
        u = link[v]
        if below[v] > most[u]:
            most[u], heavy[u] = below[v], v
    head = list(range(len(link)))
    for v in order[1:]:
        if heavy[link[v]] == v:
            head[v] = head[link[v]]
    return head


def runs_in(words: list[int]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of ``words``, sorted by start, then period."""
    link, size, prefixes = automaton(words)
    head = heavy_paths(link, size)
    stacks: dict[int, list[tuple[int, int]]] = {}
    ends: dict[tuple[int, int], int] = {}
    for i, v in enumerate(prefixes):
        squares = None
        while v > 0:
            top, n = head[v], size[v]
            stack = stacks.get(top)
            if stack is None:
                stacks[top] = [(n, i)]
            else:
                while stack:
                    upto, e = stack[-1]
                    if upto <= n:
                        stack.pop()
                    met = upto if upto < n else n
                    q = i - e
                    if met >= (MIN_PERIODS - 1) * q and met + q >= MIN_RUN:
                        if squares is None:
                            squares = {q: met}
                        elif squares.get(q, 0) < met:
                            squares[q] = met
                    if upto >= n:
                        break
                stack.append((n, i))
            v = link[top]
        if squares:
            for q, met in squares.items():
                ends[i - met - q + 1, q] = i
    return sorted((start, end - start + 1, q) for (start, q), end in ends.items())


def stretches(ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """``(from, to)`` of the stretches of ``ids`` that can hold a run; ``doc`` numbers the text of each word."""
    n = ids.size - 2
    if n < MIN_RUN - 2:
        return []
    _, pair = np.unique((ids[:-1].astype(np.int64) << 32) | ids[1:], return_inverse=True)
    same = np.flatnonzero(doc[:-2] == doc[2:])
    # three-word sequences by text: a stable sort brings equal ones together, text by text
    _, triple = np.unique((pair[same].astype(np.int64) << 32) | ids[same + 2], return_inverse=True)
    _, group, times = np.unique((triple.astype(np.int64) << 32) | doc[same], return_inverse=True, return_counts=True)
    often = np.zeros(n + 2, np.int8)
    often[same[times[group] >= 3] + 1] = 1
    edges = np.flatnonzero(np.diff(often))
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= MIN_RUN - 2
    # a stretch of sequences is one of texts too: the two words after its last one end it
    return list(zip(starts[long].tolist(), (stops[long] + 2).tolist()))


def planted(n: int, key: int | None) -> np.ndarray | None:
    """Numbers of the original words that stand in a text of n words with that id; None: all as they are."""
    if key is None or not n:
        return None
    h = crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The row of a text: counts, its most repetitive run, digests."""
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:  # runs come by start, then period
            best = (start, length, period)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    if runs:
        words = [words[i] for i in np.flatnonzero(kept(len(words), runs)).tolist()]
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())


def texts_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text."""
    number: dict[bytes, int] = {}
    for words in texts:
        for w in words:
            number.setdefault(w, len(number))
    sizes = np.array([len(words) for words in texts])
    ids = np.fromiter((number[w] for words in texts for w in words), np.int64, int(sizes.sum()))
    doc, begin = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in stretches(ids, doc):
        text = int(doc[a])
        shift = a - int(begin[text])
        found[text] += [(start + shift, length, q) for start, length, q in runs_in(ids[a:b].tolist())]
    return found


def find_runs(df: DataFrame, key: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """``key`` and, per row of ``df``, ``n_runs``, the run with the greatest exponent and digests of runs and text.

    Words are maximal sequences without ASCII white space. ``start, length, period, exponent_milli`` are null
    without a run; equal exponents go to the smallest start, then period. ``runs_sha256`` digests the lines
    ``start,length,period`` of all runs, ``collapsed_sha256`` the words outside the repetitions of any run,
    joined by one space. A null or empty text has no words, no runs and the digests of the empty string.
    With ``plant``, texts of some ids first become periodic (see ``planted``); a null id never does. Repeated
    rows give repeated rows, further columns are not read, an empty table gives no row. Nothing is shuffled;
    a text is held by one task, whatever its length.
    """
    source = df.select(F.col(key).cast("long").alias(key), F.col(text_col).alias("__text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "__text"):
                keys = part.column(key).to_pylist()
                texts = [(t or "").encode().split() for t in part.column("__text").to_pylist()]
                if plant:
                    for i, k in enumerate(keys):
                        at = planted(len(texts[i]), k)
                        if at is not None:
                            texts[i] = [texts[i][j] for j in at.tolist()]
                rows = [described(words, runs) for words, runs in zip(texts, texts_runs(texts), strict=True)]
                columns = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), COLUMNS.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(key), *columns], names=[key, *COLUMNS])

    return source.mapInArrow(kernel, f"`{key}` long, {SCHEMA}")
