"""Item co-occurrence recommendation on ``(user_id, item_id, pref)`` ratings.

The reference chains seven text-file jobs; here it is

    ratings → dedupe → co-occurrence C[i, j] (users who rated both)
            → score[i, u] = Σ_y C[i, y] · pref[u, y] → per-user ranking

Scale notes
-----------
* Items are cut into blocks of about ``BLOCK_ITEMS`` by a hash. One plan serves every catalogue size.
* Co-occurrence is the Gram matrix RᵀR. A user's items are gathered per block, and each pair of a user's
  blocks is one row, so the pairs of a heavy user are spread over many tasks. A task counts a pair of blocks
  into a packed tile, whose memory follows the cells that exist; strips of a tile are added up in many tasks.
  One triangle is computed, the other is its mirror.
* Scores for all users are a blocked product over packed rows: a task holds the matrix columns of some target
  items and streams slices of users past them. The copies of the matrix follow the number of tasks, not of
  users. For the n best, groups of targets are skipped where a bound from their largest cells is below the
  n-th score so far. A row exists where the user rated an item that co-occurs, whatever the values.
* Scores for one user never build C: with w[v] = Σ_y R[v, y]·pref[u, y], score[i] = Σ_v R[v, i]·w[v],
  two joins and two aggregates with map-side combining.
* Choosing the number of blocks takes two small counts over the checkpointed ratings while the plan is built;
  every function takes the counts as arguments to avoid that.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import tiles
from quarry.operators.common import broadcast_if_small
from quarry.session import cut_lineage

# Items of a block; cells of the matrix that a task of a product holds.
BLOCK_ITEMS = 2048
COLUMN_CELLS = 1 << 23
# Where pairs are few: pairs that a task counts, and cells that a task of a product holds (about 8 bytes each).
PART_PAIRS, TARGET_CELLS = 1 << 21, 1 << 25
# Ratings and users of a slice, on average.
SLICE_RATINGS = 1 << 18
SLICE_USERS = 1 << 16
# Gathers (vectors) are cut into blocks of at most this many ids.
DEFAULT_BLOCK = 1000


# --------------------------------------------------------------------------- dedupe

def dedupe_ratings(r: DataFrame, how: str = "sum", order_col: str | Sequence[str] | None = None) -> DataFrame:
    """One row per (user, item). ``how``: sum | max | min | last (needs ``order_col``, one or several).

    ``last`` is the pref with the greatest order value (compared column by column); equal order values go
    to the greatest pref.
    """
    if how == "last":
        if not order_col:
            raise ValueError("how='last' needs an order column; rows have no order in Spark")
        order = [order_col] if isinstance(order_col, str) else list(order_col)
        agg = F.max(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.col("pref").alias("pref")))["pref"]
    elif how in ("sum", "max", "min"):
        agg = getattr(F, how)("pref")
    else:
        raise ValueError(f"unknown dedupe {how!r}")
    out = r.groupBy("user_id", "item_id").agg(agg.alias("pref"))
    if how == "sum":
        out = out.select("user_id", "item_id", F.col("pref").cast(r.schema["pref"].dataType).alias("pref"))
    return out


# --------------------------------------------------------------------------- gathers

def _block(c: str, size: int):
    return F.floor(F.col(c) / F.lit(size)).cast("bigint")


def _packed(key: str, val: str):
    """'k:v,k:v' of the collected (key, val) structs, sorted by key."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(val).alias("v"))))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["k"].cast("string"),
                                                                   e["v"].cast("string"))), ",")


def user_vectors(r: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``(user_id, block, n_items, vec)`` with vec = 'item:pref,…' sorted by item.

    Items are gathered per (user, item block) so one row holds at most
    ``block_size`` entries whatever the user's activity.
    """
    return (r.groupBy("user_id", _block("item_id", block_size).alias("block"))
            .agg(F.count(F.lit(1)).alias("n_items"), _packed("item_id", "pref").alias("vec")))


def item_vectors(s: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``(item_id, block, n_users, vec)`` with vec = 'user:score,…' sorted by user."""
    return (s.groupBy("item_id", _block("user_id", block_size).alias("block"))
            .agg(F.count(F.lit(1)).alias("n_users"), _packed("user_id", "score").alias("vec")))


# --------------------------------------------------------------------------- blocks

@dataclass(frozen=True)
class Sizes:
    """What the number of blocks depends on: items, users, ratings and item pairs within users."""
    items: int
    users: int
    ratings: int
    pairs: float

    @property
    def block_items(self) -> int:
        """Items of a block: more of them where pairs cannot fill a matrix of all items."""
        return 4 * BLOCK_ITEMS if self.few_pairs else BLOCK_ITEMS

    @property
    def few_pairs(self) -> bool:
        return self.pairs * 16 < float(self.items) ** 2

    @property
    def listed(self) -> bool:
        """Whether whole lists of items meet parts of the items: pairs of many blocks would be rows of an item or two."""
        return self.few_pairs and self.blocks > 1

    @property
    def blocks(self) -> int:
        return max(1, -(-self.items // self.block_items))

    @property
    def subs(self) -> int:
        """Parts of a block of target items, so that the cells of one part fit a task."""
        return max(1, math.ceil(min(float(self.items) ** 2, self.pairs) / self.blocks / COLUMN_CELLS))


def measure(r: DataFrame, n_items: int | None = None, n_users: int | None = None) -> Sizes:
    """Sizes of ratings by two small jobs; with both counts given by none, as if every user rated much."""
    if n_items is not None and n_users is not None:
        return Sizes(n_items, n_users, n_items * n_users, float(n_items) ** 2)
    per_user = r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    users, ratings, pairs = per_user.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n").cast("double") ** 2)).first()
    items = r.select("item_id").distinct().count() if n_items is None else n_items
    return Sizes(items, users, ratings or 0, pairs or 0.0)


def _of(c: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(blocks)).cast("int")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# --------------------------------------------------------------------------- co-occurrence

def block_pairs(r: DataFrame, blocks: int) -> DataFrame:
    """``b1, b2, part, left, right``: one row for each pair of a user's item blocks, dealt over ``part``.

    The item sets are deduplicated before they are gathered and hold one block's items at most. Within one
    block ``right`` is empty: it is ``left``.
    """
    parts = max(1, -(-_partitions(r) * 2 // (blocks * (blocks + 1))))
    mine = (r.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
            .groupBy("user_id", _of("item_id", blocks).alias("b"))
            .agg(F.collect_set(F.col("item_id").cast("bigint")).alias("items")))
    left = mine.select("user_id", F.col("b").alias("b1"), F.col("items").alias("left"))
    pairs = left.select("user_id", "b1", F.col("b1").alias("b2"), "left", F.array().cast("array<bigint>").alias("right"))
    if blocks > 1:
        other = mine.select("user_id", F.col("b").alias("b2"), F.col("items").alias("right"))
        pairs = left.join(other, "user_id").where(F.col("b1") <= F.col("b2")).select("user_id", "b1", "b2", "left", F.when(
            F.col("b1") == F.col("b2"), F.array().cast("array<bigint>")).otherwise(F.col("right")).alias("right"))
    return pairs.select("b1", "b2", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int").alias("part"), "left", "right")


def _strips(r: DataFrame, blocks: int) -> DataFrame:
    """Packed parts of the counts (``tiles.CELLS``), brought together by strip of a pair of blocks."""
    strips = max(1, -(-_partitions(r) * 2 // (blocks * (blocks + 1))))
    keys = ["b1", "b2", "part"]
    parts = block_pairs(r, blocks).repartition(*keys).sortWithinPartitions(*keys).drop("part").mapInArrow(
        tiles.gram_strips(strips), tiles.CELLS)
    keys = ["b1", "b2", "strip"]
    return parts.repartition(*keys).sortWithinPartitions(*keys)


def _lists(r: DataFrame, parts: int) -> DataFrame:
    """Lists of users (``tiles.LISTS``), brought together by part of the items; a part is a task.

    A rating is sent once for each part that the user has items of, and a part counts complete rows of the matrix:
    no cell is shuffled, and what is summed up per item leaves one task only.
    """
    mine = r.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"))
    lists = mine.repartition("user_id").sortWithinPartitions("user_id", "item_id").mapInArrow(tiles.item_lists(parts), tiles.LISTS)
    return lists.repartitionById(parts, "part")


def _parts(r: DataFrame, sizes: Sizes) -> int:
    return max(r.sparkSession.sparkContext.defaultParallelism, math.ceil(sizes.pairs / PART_PAIRS))


def cooccurrence(r: DataFrame, n_items: int | None = None, sizes: Sizes | None = None) -> DataFrame:
    """``(item1, item2, n)``: users that rated both items, every ordered pair
    including i = j (the diagonal is the number of users of the item).

    ``r`` needs ``user_id, item_id``; duplicates and rows with a null user or item are left out.
    """
    if sizes is None:
        r = cut_lineage(r.select("user_id", "item_id"))
        sizes = measure(r, n_items)
    if sizes.listed:
        return _lists(r, _parts(r, sizes)).mapInArrow(tiles.counted_lists(tiles.listed_rows), "item1 bigint, item2 bigint, n bigint")
    return _strips(r, sizes.blocks).mapInArrow(tiles.merged_strips(tiles.as_rows), "item1 bigint, item2 bigint, n bigint")


# --------------------------------------------------------------------------- scores

def _pref(t: T.DataType) -> tuple[Column, str, Column]:
    """How prefs of a type are multiplied: as long or double, the Arrow type's name, and the score from it.

    A null pref counts as 0: it marks that the user rated the item.
    """
    pref, score = F.coalesce(F.col("pref"), F.lit(0)), F.col("score")
    if isinstance(t, T.DecimalType):
        unit = F.lit(10 ** t.scale).cast("decimal(38,0)")
        return (pref.cast(t) * unit).cast("bigint"), "bigint", (score.cast("decimal(38,0)") / unit).cast(T.DecimalType(38, t.scale))
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return pref.cast("double"), "double", score
    return pref.cast("bigint"), "bigint", score


def product_rows(r: DataFrame, raters: DataFrame, cooc: DataFrame | None, sizes: Sizes, kind_of: str) -> tuple[DataFrame, int]:
    """``key`` plus ``tiles.TILE`` rows that meet in a product, and the number of keys.

    A key is a part of the target items times a group of users. There are about as many keys as tasks, so the
    copies of the matrix do not grow with the number of users; slices of a group's users stream past it.
    """
    blocks, subs = sizes.blocks, sizes.subs
    listed = cooc is None and sizes.listed
    if listed:  # the ratings are copied for each target, so a target is as large as a task can hold
        cores = r.sparkSession.sparkContext.defaultParallelism
        targets, groups = max(cores, math.ceil(sizes.pairs / TARGET_CELLS)), 1
    else:
        targets = blocks * subs
        groups = max(1, min(-(-_partitions(r) // targets), sizes.users))
    slices = groups * max(1, -(-sizes.ratings // (groups * SLICE_RATINGS)), -(-sizes.users // (groups * SLICE_USERS)))
    if listed:
        parts = targets * -(-_parts(r, sizes) // targets)
        held = _lists(raters, parts).mapInArrow(tiles.counted_lists(tiles.listed_targets(targets)), tiles.TILE)
    elif cooc is None:
        held = _strips(raters, blocks).mapInArrow(tiles.merged_strips(tiles.as_targets(subs)), tiles.TILE)
    else:
        cells = cooc.select("item1", "item2", F.col("n").cast("bigint").alias("n"), _of("item1", blocks).alias("b1"), _of("item2", blocks).alias("b2"))
        held = cells.repartition("b1", "b2").sortWithinPartitions("b1", "b2").mapInArrow(tiles.cell_tiles(subs), tiles.TILE)
    packed = (r.select("user_id", "item_id", F.col("pref").cast(kind_of).alias("v"), _of("user_id", slices).alias("slice"))
              .repartition("slice").sortWithinPartitions("slice", "user_id", "item_id")
              .mapInArrow(tiles.rating_slices, "slice int, " + tiles.TILE.replace("target int, kind int, ", "")))
    fields = [f.split()[0] for f in tiles.TILE.split(", ")[1:]]
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    every_target = F.explode(F.sequence(F.lit(0), F.lit(targets - 1)))
    of_tiles = held.select("*", every_group.alias("g")).select((F.col("target") * groups + F.col("g")).alias("key"), *fields)
    of_slices = packed.select("*", every_target.alias("target"), F.lit(1).alias("kind")).select(
        (F.col("target") * groups + F.col("slice") % groups).alias("key"), *fields)
    return of_tiles.union(of_slices), targets * groups


def _all_scores(r: DataFrame, cooc: DataFrame | None, top_n: int | None, exclude_seen: bool,
                n_items: int | None, n_users: int | None, raters: DataFrame | None = None, fill: bool = False) -> DataFrame:
    pref, kind_of, final = _pref(r.schema["pref"].dataType)
    own = raters is None
    r = r.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"), pref.alias("pref"))
    if n_items is None or n_users is None:
        r = cut_lineage(r)  # read by the counts, the matrix and the product
    if own:
        raters = r
    elif n_items is None or n_users is None:
        raters = cut_lineage(raters.select("user_id", "item_id"))
    sizes = measure(raters, n_items, n_users)
    keyed, keys = product_rows(r, raters, cooc, sizes, kind_of)
    got = keyed.repartitionById(keys, "key").sortWithinPartitions("key", "kind").mapInArrow(
        tiles.product(top_n, exclude_seen, kind_of == "bigint", cooc is None and sizes.listed, fill), f"item_id bigint, user_id bigint, score {kind_of}")
    return got.select("item_id", "user_id", final.alias("score"))


def scores(r: DataFrame, cooc: DataFrame | None = None, user_id: int | None = None, n_items: int | None = None,
           n_users: int | None = None, zero_fill: bool = False, raters: DataFrame | None = None) -> DataFrame:
    """``(item_id, user_id, score)`` with score = Σ_y C[item, y] · pref[user, y].

    ``r`` must be deduplicated (one row per user and item). A row exists where the user rated an item
    that co-occurs with the row's item, also if the score is 0; ``zero_fill`` adds the other items of
    the catalogue with 0. Integer prefs give exact 64-bit scores and fail beyond, decimals keep their
    scale, float and double give doubles; a null pref counts as 0. If ``r`` holds some users' ratings
    only, ``raters`` are the ratings of all, which C and the catalogue come from; or ``cooc`` is C.

    With ``user_id`` the one-user form is used, which never builds C.
    """
    if user_id is None:
        s = _all_scores(r, cooc, None, False, n_items, n_users, raters, fill=zero_fill and cooc is None)
    else:
        s = _one_user(r, user_id)
    if not zero_fill:
        return s
    if user_id is None and cooc is None:
        for slots in _unmet_slots(r, r if raters is None else raters):
            s = s.unionByName(slots.select("item_id", "user_id", F.lit(0).cast(s.schema["score"].dataType).alias("score")))
        return s
    users = (r.select("user_id").distinct() if user_id is None else r.sparkSession.range(1).select(F.lit(user_id).alias("user_id")))
    slots = catalogue_slots(r if raters is None else raters, users.select(F.col("user_id").cast("bigint").alias("user_id")))
    zero = F.lit(0).cast(s.schema["score"].dataType)
    return slots.join(s, ["item_id", "user_id"], "left").select("item_id", "user_id", F.coalesce("score", zero).alias("score"))


def catalogue_slots(r: DataFrame, users: DataFrame) -> DataFrame:
    """Every ``item_id, user_id``: each user is dealt the numbers of all blocks of the catalogue, and joined with them.

    The key is (block, part of the users), so a catalogue of one block is joined by many tasks too.
    """
    listed = r.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id")).distinct()
    blocks = max(1, -(-listed.count() // DEFAULT_BLOCK))
    parts = max(1, -(-_partitions(r) * 2 // blocks))
    listed = listed.groupBy(_of("item_id", blocks).alias("block")).agg(F.collect_list("item_id").alias("items"))
    listed = listed.select("block", "items", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    wanted = users.where(F.col("user_id").isNotNull()).select(
        "user_id", _of("user_id", parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return wanted.join(listed, ["block", "part"]).select(F.explode("items").alias("item_id"), "user_id")


def _unmet_slots(r: DataFrame, raters: DataFrame) -> list[DataFrame]:
    """Slots that a product cannot know of: of items that only null users rated, and users that rated only null items."""
    def split(df: DataFrame, c: str, other: str) -> tuple[DataFrame, DataFrame]:
        """The values of ``c`` with and without a row that names ``other``."""
        of = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("bigint").alias(c)).agg(F.count(other).alias("n"))
        return of.where("n > 0").select(c), of.where("n = 0").select(c)

    users, no_items = split(r, "user_id", "item_id")
    items, no_users = split(raters, "item_id", "user_id")
    pairs = [(no_users, users.union(no_items)), (items, no_items)]
    return [catalogue_slots(a, b) for a, b in pairs if not a.isEmpty() and not b.isEmpty()]


def _one_user(r: DataFrame, user_id: int) -> DataFrame:
    """Scores of one user: partial sums of its prefs per rater, then of the raters' weights per item."""
    pref, _, final = _pref(r.schema["pref"].dataType)
    r = r.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()).select(
        "user_id", F.col("item_id").cast("bigint").alias("item_id"), pref.alias("_p"))
    mine = r.where(F.col("user_id") == F.lit(user_id)).select(F.col("item_id").alias("_y"), "_p")
    mine = broadcast_if_small(mine)
    weights = (r.select("user_id", "item_id").join(mine, F.col("item_id") == F.col("_y"))
               .groupBy("user_id").agg(F.try_sum("_p").alias("_w"), F.count("_p").alias("_n")))
    got = (r.select("user_id", "item_id").join(weights, "user_id").groupBy("item_id")
           .agg(F.try_sum(F.coalesce("_w", F.raise_error(F.lit("a weight exceeds 64 bits")))).alias("score")))
    got = got.withColumn("score", F.coalesce("score", F.raise_error(F.lit("a score exceeds 64 bits"))))
    return got.select("item_id", F.lit(user_id).cast("bigint").alias("user_id"), final.alias("score"))


def top_scores(r: DataFrame, n: int, exclude_seen: bool = False, cooc: DataFrame | None = None,
               n_items: int | None = None, n_users: int | None = None) -> DataFrame:
    """``(user_id, item_id, score, rank)``: the n best items of every user.

    Each task keeps the n best of a user among one block of items, with the rated ones left out before
    if ``exclude_seen``; the ranking then sees n rows per user and block.
    """
    return rank(_all_scores(r, cooc, n, exclude_seen, n_items, n_users), n=n)


def dense_scores(r: DataFrame, n_items: int, out_of_range: str = "error") -> DataFrame:
    """``(user_id, item_id, score)`` for every user and every item 0..n_items-1,
    with 0 where the user has no rating. An item outside the range fails the job, or is left out
    with ``out_of_range="drop"``.

    ``r`` must be deduplicated. No cross join: each user is dealt the numbers of all blocks of the catalogue,
    one row per user and block gathers the ratings there (at most ``DEFAULT_BLOCK``), and its items are
    generated beside them, so no row holds more of the catalogue than a block.
    """
    in_range = F.col("item_id").between(0, n_items - 1)
    if out_of_range == "error":
        in_range = F.when(in_range, True).otherwise(F.raise_error(F.lit(f"item outside 0..{n_items - 1}")))
    elif out_of_range != "drop":
        raise ValueError(f"unknown out_of_range {out_of_range!r}")
    entry = F.struct(F.col("item_id").cast("bigint").alias("k"), F.col("pref").alias("v"))
    last = F.lit((n_items - 1) // DEFAULT_BLOCK).cast("bigint")
    # an out-of-range item that is dropped still names its user
    rated = r.select("user_id", F.when(in_range, _block("item_id", DEFAULT_BLOCK)).alias("block"), F.when(in_range, entry).alias("entry"))
    slots = r.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"),
                                                  F.lit(None).cast(rated.schema["entry"].dataType).alias("entry"))
    rows = rated.where("block IS NOT NULL").union(slots).groupBy("user_id", "block").agg(
        F.map_from_entries(F.collect_list("entry")).alias("_m"))
    zero = F.lit(0).cast(r.schema["pref"].dataType)
    first = F.col("block") * DEFAULT_BLOCK
    items = F.sequence(first, F.least(first + DEFAULT_BLOCK, F.lit(n_items).cast("bigint")) - 1)
    return rows.select("user_id", "_m", F.explode(items).alias("item_id")).select(
        "user_id", "item_id", F.coalesce(F.try_element_at("_m", F.col("item_id")), zero).alias("score"))


# --------------------------------------------------------------------------- ranking

def rank(s: DataFrame, n: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """``(user_id, item_id, score, rank)``: items by score descending, then item id.

    ``seen`` (user_id, item_id) removes items the user already rated; by default
    they stay, as in the reference. ``n`` keeps the first n per user.
    """
    if seen is not None:
        s = s.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("item_id").asc())
    out = s.select("user_id", "item_id", "score", F.row_number().over(w).alias("rank"))
    return out if n is None else out.where(F.col("rank") <= n)


def rank_one(s: DataFrame, n: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """The ranking of one user's ``(item_id, user_id, score)``: the first ``n``, or all, spread over many tasks.

    For all, the scores are dealt into ranges and ranked inside them; each range is then moved on by the number
    of rows before it. The scores are checkpointed, as finding the ranges reads them once more, and so are the
    dealt rows, as both steps must see the same ranges.
    """
    if seen is not None:
        s = s.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    order = [F.col("score").desc(), F.col("item_id").asc()]
    if n is not None:
        return rank(s.orderBy(*order).limit(n))
    dealt = cut_lineage(cut_lineage(s).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return ranked.join(F.broadcast(sizes.select("_part", "_before")), "_part").select(
        "user_id", "item_id", "score", (F.col("_rank") + F.col("_before")).cast("int").alias("rank"))


def for_user(s: DataFrame, user_id: int) -> DataFrame:
    return s.where(F.col("user_id") == F.lit(user_id))
