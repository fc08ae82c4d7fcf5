"""SimHash near-duplicates found with BK-trees.

Fingerprints are linked at a small Hamming distance. Their bits are cut into one block more than that
distance, so two linked fingerprints agree on at least one block: every block value is a shard, and each
fingerprint goes to the shards of its blocks. A shard's fingerprints form a BK-tree, whose children are
keyed by their integer distance to the parent; a search at distance r follows only the edges within r of
its own distance to the node. A large shard is cut into several trees, and every tree is searched for the
members of every other one. Trees are built where their shard is and never pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import broadcast_if_small, by_bytes, saved
from quarry.llm.components import connected_components

SEED = 42
# Members of one BK-tree; a larger shard has several trees.
TREE = 4096
# From so many searches at once a tree is walked by arrays instead of one search at a time.
MANY = 32


def fingerprints_of(texts: list[str], shingle: int) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text's word shingles, repeats included; zero without words."""
    hashes: list[int] = []
    counts = []
    for text in texts:
        words = text.encode().lower().split()  # of bytes: A-Z and ASCII white space only
        n = len(words) - shingle + 1
        if n > 0:
            found = [b" ".join(words[i:i + shingle]) for i in range(n)] if shingle > 1 else words
        else:
            found = [b" ".join(words)] if words else []
        hashes.extend([xxhash.xxh64_intdigest(s, SEED) for s in found])
        counts.append(len(found))
    out = np.zeros(len(texts), np.uint64)
    n = np.array(counts, np.int64)
    rows = np.flatnonzero(n)
    if not len(rows):
        return out
    values = np.array(hashes, "<u8")
    starts = np.cumsum(n[rows]) - n[rows]
    for bit in range(64):
        ones = np.add.reduceat((values >> np.uint64(bit)) & np.uint64(1), starts).astype(np.int64)
        out[rows] |= (2 * ones > n[rows]).astype(np.uint64) << np.uint64(bit)
    return out


class BKTree:
    """Distinct 64-bit integers; children of a node keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        node, new = 0, len(self.value)
        while node < new:
            d = (x ^ self.value[node]).bit_count()
            if not d:
                return
            child = self.children[node].get(d)
            if child is None:
                self.children[node][d] = new
                break
            node = child
        self.value.append(x)
        self.children.append({})

    def within(self, x: int, radius: int) -> Iterator[int]:
        """Values at distance 1 to ``radius`` of x."""
        todo = [0] if self.value else []
        while todo:
            node = todo.pop()
            d = (x ^ self.value[node]).bit_count()
            if 0 < d <= radius:
                yield self.value[node]
            todo.extend(c for e, c in self.children[node].items() if abs(e - d) <= radius)

    def pairs(self, xs: list[int], radius: int) -> Iterator[tuple[int, int]]:
        """(x, value) within the radius for all of ``xs``, many searches walking the tree together."""
        if len(xs) < MANY:
            for x in xs:
                for y in self.within(x, radius):
                    yield x, y
            return
        todo = [(0, np.array(xs, np.uint64))] if self.value else []
        while todo:
            node, group = todo.pop()
            d = np.bitwise_count(group ^ np.uint64(self.value[node])).astype(np.int64)
            for x in group[(d > 0) & (d <= radius)].tolist():
                yield x, self.value[node]
            for e, child in self.children[node].items():
                part = group[np.abs(d - e) <= radius]
                if len(part):
                    todo.append((child, part))


class Groups(dict):
    """Union-find over the members of one shard."""

    def find(self, x: int) -> int:
        root = x
        while self.setdefault(root, root) != root:
            root = self[root]
        while self[x] != root:
            self[x], x = root, self[x]
        return root

    def link(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)


def shard_links(trees: list[int], searches: list[int], radius: int) -> list[tuple[int, int]]:
    """Star edges that connect what the links between ``trees`` and ``searches`` connect."""
    tree, groups = BKTree(), Groups()
    for x in trees:
        tree.add(x)
    for x, y in tree.pairs(searches, radius):
        groups.link(x, y)
    return [(x, root) for x in groups if (root := groups.find(x)) != x]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """``keep`` columns and ``fp`` (the fingerprint as a signed long) of each row."""
    keep = list(keep)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "__text"):
                found = fingerprints_of([t or "" for t in part.column("__text").to_pylist()], shingle)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found.view(np.int64))],
                                                 names=[*keep, "fp"])

    source = df.select(*keep, df[text_col].alias("__text"))
    schema = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in keep)
    return source.mapInArrow(kernel, f"{schema}fp long")


def links(distinct: DataFrame, radius: int, tree: int = TREE) -> DataFrame:
    """``a, b`` edges over distinct ``fp`` that connect exactly what pairs within ``radius`` connect."""
    bounds = [64 * i // (radius + 1) for i in range(radius + 2)]
    blocks = [F.struct(F.lit(i).cast("byte").alias("block"),
                       F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1)).alias("bits"))
              for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))]
    members = distinct.select("fp", F.inline(F.array(*blocks)))
    large = (members.groupBy("block", "bits").agg(F.count("*").alias("n")).where(F.col("n") > 1)
             .select("block", "bits", F.ceil(F.col("n") / tree).cast("int").alias("trees")))
    dealt = members.join(large, ["block", "bits"]).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("trees") - 1))
    dealt = dealt.select("fp", "block", "bits", "own", other.alias("other")).select(
        "fp", "own", F.xxhash64("block", "bits").alias("shard"), F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, int, int, int]]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "i", "j", "fp", "own")), strict=True)

        out: list[tuple[int, int]] = []
        for (_, i, j), group in groupby(rows(), key=lambda r: r[:3]):
            sides: tuple[list[int], list[int]] = ([], [])
            for _, _, _, fp, own in group:
                sides[own != i].append(fp & 0xFFFFFFFFFFFFFFFF)
            out.extend(shard_links(sides[0], sides[0] if i == j else sides[1], radius))
            if len(out) > 50_000:
                yield edges(out)
                out = []
        yield edges(out)

    def edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([signed(x[k]) for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    # a shard's key may collide with another's: its members are then compared too, and no link is made up
    return (dealt.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j")
            .mapInArrow(kernel, "a long, b long"))


def roots_of(found: DataFrame, radius: int) -> DataFrame:
    """``fp, root`` for every distinct ``fp``: the least fingerprint reachable over links."""
    distinct = saved(found.select("fp").distinct())
    roots = connected_components(links(distinct, radius))
    return saved(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(df: DataFrame, text_col: str = "text", key: str = "doc_id", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (least key reachable) of every row.

    Rows are linked where their fingerprints differ in at most ``radius`` bits; a null text counts as
    empty, and texts without words share the fingerprint zero and are linked like any other. A null key
    is never the least one: a component of null keys only has a null id. Repeated rows each get their
    row. Only ``key`` and ``text_col`` are read, and an empty table gives an empty result.
    """
    found = saved(fingerprints(df, text_col, (key,), shingle))
    least = found.groupBy("fp").agg(F.min(key).alias("least")).join(roots_of(found, radius), "fp")
    least = saved(least)
    components = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(components, "root").select("fp", "component_id")
    return found.join(named, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, text_col: str = "text", key: str = "doc_id", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``df`` that stay when one row of every component does: that of its least key, then text hash.

    A row with a key goes before one without. Rows equal in key and text are copies, of which one stays.
    Of the tables only the keys are shuffled, apart from the few rows that have such copies.
    """
    rows = df.withColumn("__doc", F.xxhash64(text_col))
    found = saved(fingerprints(rows, text_col, (key, "__doc"), shingle))
    place = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col("__doc").alias("doc"))
    placed = found.join(roots_of(found, radius), "fp").select("root", place.alias("place"))
    first = placed.groupBy("root").agg(F.min("place").alias("kept"))
    named = ["key", "doc", "times"]
    seen = saved(placed.groupBy("root", "place").count().join(first, "root").select(
        "place.key", "place.doc", F.col("count").alias("times"), (F.col("place") == F.col("kept")).alias("stays")))
    same = rows[key].eqNullSafe(F.col("key")) & (rows["__doc"] == F.col("doc"))
    gone = broadcast_if_small(saved(seen.where("not stays").select(*named)))
    several = broadcast_if_small(saved(seen.where("stays and times > 1").select(*named)))
    left = rows.join(gone, same, "left_anti")
    single = left.join(several, same, "left_anti")
    return single.union(left.join(several, same, "left_semi").dropDuplicates([key, "__doc"])).drop("__doc")
