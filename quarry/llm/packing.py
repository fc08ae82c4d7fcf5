"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids are its tokens and then the end id. Every full window of ``capacity`` ids stands alone;
what is left of the document is cut into pieces of at most ``piece`` ids. Each task packs its own pieces,
``group`` at a time and as they come, so no shuffle, no key and no whole table is ever gathered. In a group
the largest differencing method runs over k windows: every piece begins as a partition of its own, and
the two partitions whose loads differ most are merged, the fullest windows of one with the emptiest of the
other, which leaves nearly equal windows. If one of them exceeds the capacity, k rises and the group is
packed anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from quarry.llm.common import by_bytes
from quarry.llm.token_counts import byte_letters

COLUMNS = {"start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
           "sequence_id": pa.int64(), "offset": pa.int64()}
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
END_ID = 1
# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def spread_into(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in k windows by multiway differencing, nearly equal in load.

    A partition is its non-empty windows, fullest first, each (load, indices nested as pairs). As long as
    two partitions have at most k windows together, pairing full with empty windows is their union.
    """
    heap: list[tuple[int, int, list]] = []
    for i, n in enumerate(sizes):
        heapq.heappush(heap, (-n, i, [(n, i)]))
    made = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        shared = max(0, len(a) + len(b) - k)
        # the emptiest `shared` windows of a meet the emptiest of b in opposite order
        head_a, tail_a = a[:len(a) - shared], a[len(a) - shared:]
        head_b, tail_b = b[:len(b) - shared], b[len(b) - shared:]
        joined = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(tail_a, reversed(tail_b), strict=True)]
        merged = sorted(head_a + head_b + joined, key=lambda w: -w[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], made, merged))
        made += 1
    windows = []
    for _, nested in heap[0][2] if heap else []:
        flat, todo = [], [nested]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                flat.append(x)
        windows.append(sorted(flat))
    return windows


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: as few as the total allows, one more whenever one overflows."""
    k = max(1, -(-sum(sizes) // capacity))
    while sizes:
        windows = spread_into(sizes, k)
        if max(sum(sizes[i] for i in w) for w in windows) <= capacity:
            return windows
        k += 1
    return []


class Ids:
    """Ids of the byte-level BPE, as unsigned 32-bit integers.

    The ranks come from the tokenizer's own file; tests hold the ids against the tokenizer itself.
    """

    def __init__(self, path: str):
        tok = Tokenizer.from_file(path)
        letters = byte_letters()
        special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
        ranks = {bytes(letters[c] for c in entry): i
                 for entry, i in tok.get_vocab(with_added_tokens=False).items() if entry not in special}
        self.coder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for text in texts:
            yield self.coder.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def cuts(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document of n ids: full windows, then near-equal pieces of at most ``piece`` ids."""
    full = [(i, capacity) for i in range(0, n - capacity + 1, capacity)]
    at, rest = len(full) * capacity, n % capacity
    parts = -(-rest // piece)
    for i in range(parts):
        size = (rest * (i + 1)) // parts - (rest * i) // parts
        full.append((at, size))
        at += size
    return full


def pack(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
         capacity: int = 2048, piece: int = 512, group: int = 1024) -> DataFrame:
    """One row per piece: ``keep`` columns, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Every id of every document, its end id included, lies in exactly one piece; the pieces of a sequence
    follow each other from offset 0 and hold at most ``capacity`` ids. A null text is an empty one: only the
    end id. Repeated rows and null keys are packed like any other row, further columns are not read, an
    empty table gives no row. Sequence ids are unique over all tasks and repeat when a task is run again.
    ``path`` must exist on every executor.
    """
    keep = list(keep)

    source = df.select(*keep, df[text_col].alias("__text"))
    arrow = to_arrow_schema(source.select(*keep).schema)
    types = [*arrow.types, *COLUMNS.values()]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, next_id = Ids(path), TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []  # pieces below the capacity: keep values, start, length, crc, tokens

        def rows(pieces: list[tuple], windows: list[list[int]]) -> pa.RecordBatch:
            nonlocal next_id
            out = []
            for w in windows:
                offset = 0
                for i in w:
                    out.append((*pieces[i], next_id, offset))
                    offset += pieces[i][len(keep) + 1]
                next_id += 1
            columns = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[*keep, *COLUMNS])

        def packed(n: int) -> pa.RecordBatch:
            pieces = [waiting.pop() for _ in range(n)]
            return rows(pieces, balanced([p[len(keep) + 1] for p in pieces], capacity))

        for batch in batches:
            for part in by_bytes(batch, "__text", 2 << 20):
                *keys, texts = (part.column(c).to_pylist() for c in [*keep, "__text"])
                full = []
                for *key, found in zip(*keys, ids.of([t or "" for t in texts]), strict=True):
                    doc = np.append(found, np.uint32(END_ID)).astype("<u4")
                    for start, n in cuts(len(doc), capacity, piece):
                        cut = (*key, start, n, crc32(doc[start:start + n]), len(doc))
                        (full if n == capacity else waiting).append(cut)
                if full:
                    yield rows(full, [[i] for i in range(len(full))])
                while len(waiting) >= group:
                    yield packed(group)
        if waiting:
            yield packed(len(waiting))

    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(kernel, f"{schema + ', ' if keep else ''}{SCHEMA}")
