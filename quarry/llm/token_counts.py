"""Token counts with the whole-token shortcut.

A byte-level BPE tokenizer with word ends splits a text into pre-tokens and merges each by itself.
Most pre-tokens of ordinary text are themselves strings of the vocabulary. ``whole_tokens`` proves,
once and offline, which vocabulary strings encode alone as exactly one token; a pre-token of that set
counts 1 without any merging. Only the rest goes through the tokenizer's merges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from quarry.llm.common import by_bytes

SCHEMA = "n_bytes long, n_tokens long, over_limit boolean"
# Distinct space-free chunks a task remembers; beyond it the memory starts anew (speed only).
MEMORY = 400_000


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 + rank."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def split_pattern(path: str) -> str:
    """The pre-token pattern that the tokenizer file itself states."""
    with open(path, encoding="utf-8") as f:
        steps = json.load(f)["pre_tokenizer"]["pretokenizers"]
    return next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and that the tokenizer encodes alone as one token.

    A candidate is an entry with the word-end suffix, decoded from the byte alphabet. It is taken
    only if the normalizer leaves it as it is, the split pattern keeps it whole and encoding it
    gives its own id and nothing else. Bounded by the vocabulary.
    """
    tok, letters, pattern = Tokenizer.from_file(path), byte_letters(), regex.compile(split_pattern(path))
    found: dict[str, int] = {}
    for entry, token_id in tok.get_vocab(with_added_tokens=False).items():
        if entry.endswith("</w>") and all(c in letters for c in entry[:-4]):
            try:
                word = bytes(letters[c] for c in entry[:-4]).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if word and tok.normalizer.normalize_str(word) == word and pattern.findall(word) == [word]:
                found[word] = token_id
    words = list(found)
    coded = tok.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, coded, strict=True) if e.ids == [found[w]])


class Counter(dict):
    """Tokens of a space-free chunk, computed on first sight.

    No pre-token, normalization step or special string reaches across a space or a newline, so the
    tokens of a text are the sum over its chunks. A chunk that holds a special string goes to the
    tokenizer whole, with the library's default treatment.
    """

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__()
        self.tok, self.whole = Tokenizer.from_file(path), whole
        self.pattern = regex.compile(split_pattern(path))
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.letters = {b: c for c, b in byte_letters().items()}
        self.model, self.merged = self.tok.model, {}

    def __missing__(self, chunk: str) -> int:
        if any(s in chunk for s in self.special):
            n = len(self.tok.encode(chunk, add_special_tokens=False).ids)
        else:
            n = 0
            plain = chunk.lower() if chunk.isascii() else self.tok.normalizer.normalize_str(chunk)
            for pre in self.pattern.findall(plain):
                if pre in self.whole:
                    n += 1
                else:
                    if pre not in self.merged:
                        self.merged[pre] = self.merge(pre)
                    n += self.merged[pre]
        if len(self) >= MEMORY:
            self.clear()
        if len(self.merged) >= MEMORY:
            self.merged.clear()
        if len(chunk) <= 64:
            self[chunk] = n
        return n

    def merge(self, pre: str) -> int:
        """Tokens of one pre-token, by the tokenizer's own merges."""
        return len(self.model.tokenize(pre.encode().decode("latin-1").translate(self.letters)))

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def token_counts(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 limit: int = 2048) -> DataFrame:
    """``keep`` columns plus ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) per row.

    Null texts count as empty (0 bytes, 0 tokens). Repeated rows, null keys and extra columns of any
    name are fine: only ``keep`` and ``text_col`` are read and each row is counted by itself. An empty
    table gives an empty result. ``path`` must exist on every executor.
    """
    spark = df.sparkSession
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # at most the vocabulary
    keep = list(keep)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, whole.value)
        for batch in batches:
            for part in by_bytes(batch, "__text"):
                texts = [t or "" for t in part.column("__text").to_pylist()]
                n = [counter.count(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array([len(t.encode()) for t in texts], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    source = df.select(*keep, df[text_col].alias("__text"))
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(kernel, f"{schema + ', ' if keep else ''}{SCHEMA}")
