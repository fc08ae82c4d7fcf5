"""Mixing sources to target weights by Pareto order sampling.

A source's documents are first taken whole as often as its target holds its size: certain copies. The
rest of the target is drawn with unequal odds: longer documents are more worth a copy, so the odds of
inclusion rise by size class, at a level of the source that makes the expected words those of the rest.
Each document gets a fixed random number x; its Pareto rank is the odds x / (1 - x) over the odds of its
inclusion, and the first ranks are taken until the rest is used up. A document too large for what is left
gives way to the next ones that fit, in further passes; at last one more document is taken if that brings
the source nearer to its target.

The level of a source scales all its ranks alike and leaves their order, so ranks are compared on a common
scale of whole numbers: position = rank / (1 + rank) at level 1, in 52 bits.

The outcome is a handful of numbers per source: a document is taken in pass p if its size fits the gap
and its rank is at most the cut of that pass. So texts are never shuffled, and running sums are taken in
two steps, over rank bins and inside the one bin that holds the cut: no source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, broadcast_if_small, saved

MOST_COPIES = 3
PASSES = 4
# Random numbers and positions have 52 bits; the leading 12 are the bin.
BITS, BIN_BITS = 52, 40
# Least size of a class of documents, and its odds of inclusion against those of the first class.
CLASSES = ((0, 1.0), (50, 2.0), (250, 4.0))
# Halvings of the logarithm of a source's level, from 2^-LEVELS to 2^LEVELS.
HALVINGS, LEVELS = 60, 64


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drawn(key: Column, text: Column, seed: str) -> Column:
    """A fixed 52-bit random number of a row, from its key, its text and the seed."""
    parts = [F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def odds_of(size: Column, classes: tuple[tuple[int, float], ...]) -> Column:
    """Odds of inclusion of a document of this size, at level 1; ``classes`` rise by least size, the first from 0."""
    odds = F.lit(float(classes[0][1]))
    for least, of in classes[1:]:
        odds = F.when(size >= least, float(of)).otherwise(odds)
    return odds


def position(random: Column, odds: Column) -> Column:
    """Place of a Pareto rank among all possible ones: a whole number that rises with it, below 2^BITS."""
    x, rest = (random + 0.5) / float(1 << BITS), (float(1 << BITS) - random - 0.5) / float(1 << BITS)
    return F.least(F.floor(x / (x + odds * rest) * float(1 << BITS)), F.lit((1 << BITS) - 1)).cast("long")


def level_of(gap: Column, parts: Column) -> Column:
    """The level at which ``parts`` (``odds, words`` of the classes) give ``gap`` words on average; 0 for no gap.

    The expected words rise with the level, so its logarithm is found by halving.
    """
    def words(level: Column) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda total, p: total + p["words"] * (
            level * p["odds"] / (1.0 + level * p["odds"])))

    def step(state: Column, _: Column) -> Column:
        half = (state["low"] + state["high"]) / 2.0
        enough = words(F.pow(F.lit(2.0), half)) >= gap
        return F.struct(F.when(enough, state["low"]).otherwise(half).alias("low"), F.when(enough, half).otherwise(state["high"]).alias("high"))

    start = F.struct(F.lit(-float(LEVELS)).alias("low"), F.lit(float(LEVELS)).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, step, lambda state: F.pow(F.lit(2.0), state["high"]))
    return F.when(gap > 0, found).otherwise(0.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source, source_size, target`` of every source.

    Sources by code point, null last, have the weights in turn. Shares of the whole size go by weight;
    a source stops at three times its size, the excess is shared anew until none is above: sources that
    stop are those with the least cap for their weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("w", weight)
    cap = F.col("source_size") * MOST_COPIES
    order = Window.orderBy((cap / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    open_weight = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = rest.cast("double") / open_weight
    # once a source is below its cap, so are all after it, at the level of the first of them: the highest
    level = total.withColumn("cap", cap).withColumn("level", F.when(level * F.col("w") < F.col("cap"), level))
    level = level.withColumn("level", F.max("level").over(everything))
    share = F.col("level") * F.col("w")
    return level.select("source", "source_size",
                        F.when(share < F.col("cap"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: ``source, whole, passes`` with the (gap, low, cut) of every pass over ``source, size, u`` rows."""
    whole = F.floor(F.try_divide("target", "source_size"))
    state = plan.select("source", F.coalesce(whole, F.lit(0)).alias("whole"),
                        F.coalesce(F.col("target") - whole * F.col("source_size"), F.lit(0.0)).alias("gap"),
                        F.lit(None).cast("array<struct<gap:double,low:long,cut:long>>").alias("passes"))
    state = saved(state.withColumn("passes", F.coalesce("passes", F.array())))
    in_bin = Window.partitionBy("source").orderBy("u")

    def left(most: Column) -> DataFrame:
        small = broadcast_if_small(state, ("source",))
        found = rows.join(small, rows["source"].eqNullSafe(small["source"])).drop(small["source"])
        return found.where((F.col("size") > 0) & (F.col("size") <= most) & ~taken_in(F.col("passes"), F.col("size"), F.col("u")))

    for _ in range(PASSES):
        open_rows = left(F.col("gap")).select(F.struct("source").alias("source"), "size", "u", "gap",
                                              F.shiftright("u", BIN_BITS).alias("bin"))
        bins = open_rows.groupBy("source", "bin").agg(F.sum("size").alias("n"), F.first("gap").alias("gap"))
        run = F.sum("n").over(Window.partitionBy("source").orderBy("bin"))
        bins = bins.withColumn("before", run - F.col("n"))
        edge = bins.where((F.col("before") <= F.col("gap")) & (F.col("before") + F.col("n") > F.col("gap")))
        inside = open_rows.drop("gap").join(edge.select("source", "bin", "before", "gap"), ["source", "bin"])
        inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(in_bin))
        inside = (inside.groupBy("source").agg(F.max(F.when(F.col("upto") <= F.col("gap"), F.col("u"))).alias("cut"),
                                               F.max(F.when(F.col("upto") <= F.col("gap"), F.col("upto"))).alias("upto"),
                                               F.min("before").alias("before"), F.min("bin").alias("bin")))
        found = (bins.groupBy("source").agg(F.sum("n").alias("n")).join(inside, "source", "left")
                 .select("source", F.coalesce("cut", F.shiftleft(F.col("bin"), BIN_BITS) - 1, F.lit((1 << BITS) - 1)).alias("cut"),
                         F.coalesce("upto", "before", "n").alias("used")))
        next_state = state.join(found, F.struct(state["source"]) == found["source"], "left").select(
            state["source"], "whole", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"),
            F.concat("passes", F.array(F.struct(F.col("gap").alias("gap"), F.lit(0).cast("long").alias("low"),
                                                F.coalesce("cut", F.lit(-1).cast("long")).alias("cut")))).alias("passes"))
        state = saved(next_state)
    off = F.abs(F.col("size") - F.col("gap"))
    last = (left(2 * F.col("gap")).where(off < F.col("gap")).groupBy(F.struct("source").alias("source"))
            .agg(F.min(F.struct(off.alias("off"), "u", "size")).alias("last")))
    one = F.array(F.struct(F.col("last.size").cast("double").alias("gap"), F.col("last.u").alias("low"), F.col("last.u").alias("cut")))
    return state.join(last, F.struct(state["source"]) == last["source"], "left").select(
        state["source"], "whole", F.when(F.col("last").isNull(), F.col("passes")).otherwise(F.concat("passes", one)).alias("passes"))


def taken_in(passes: Column, size: Column, u: Column) -> Column:
    """Whether some pass takes a document: it fits the gap and its rank is within the pass."""
    return (size > 0) & F.exists(passes, lambda p: (size <= p["gap"]) & u.between(p["low"], p["cut"]))


def _decided(df: DataFrame, key: str, text_col: str, source_col: str, weights: tuple[int, ...], seed: str,
             classes: tuple[tuple[int, float], ...]) -> DataFrame:
    """``row`` (all columns of ``df``), ``size, source_size, target, copies, inclusion, rank`` of every row."""
    rows = df.select(F.struct(*df.columns).alias("row"), df[source_col].cast("string").alias("source"),
                     word_count(df[text_col]).alias("size"), drawn(df[key], df[text_col], seed).alias("random"))
    rows = rows.withColumn("odds", odds_of(F.col("size"), classes))
    rows = rows.withColumn("u", position(F.col("random"), F.col("odds")))
    narrow = saved(rows.select("source", "size", "odds", "u"))
    plan = saved(targets(narrow, weights))
    plan = plan.join(cuts(narrow, plan).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    parts = narrow.groupBy("source", "odds").agg(F.sum("size").cast("double").alias("words")).groupBy(F.col("source").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("odds", "words"))).alias("parts"))
    plan = plan.join(parts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    level = level_of(F.col("target") - F.col("whole") * F.col("source_size"), F.col("parts"))
    plan = broadcast_if_small(saved(plan.withColumn("level", level).drop("parts").withColumnRenamed("source", "of")), ("of",))
    random = (F.col("random") + 0.5) / float(1 << BITS)
    inclusion = F.col("level") * F.col("odds") / (1.0 + F.col("level") * F.col("odds"))
    extra = taken_in(F.col("passes"), F.col("size"), F.col("u")).cast("long")
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("inclusion", inclusion)
            .select("row", "size", "source_size", "target", (F.col("whole") + extra).alias("copies"), "inclusion",
                    F.try_divide(random / (1 - random), F.col("level") * F.col("odds")).alias("rank")))


def mix(df: DataFrame, key: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix", classes: tuple[tuple[int, float], ...] = CLASSES) -> DataFrame:
    """``key, size, source_size, target, taken, copies, inclusion, rank`` of every row.

    ``inclusion`` is the odds-driven probability of a copy beyond the certain ones, ``rank`` the Pareto rank
    (null where no such copy is drawn). Documents that fill the gap a larger one left are taken beyond these
    odds, about one document's worth of words a source. ``classes`` are least sizes, rising from 0, with their odds.

    ``taken`` is ``size`` times ``copies``, at most three times the size. Documents are taken whole, so the
    words taken of a source may miss its target by a part of one document. A null text has
    size 0 and is never taken, as is any text without words; null is a source of its own, last in order.
    Rows equal in key and text share one random number and stand or fall together. A rerun on the same
    rows decides alike, however they are partitioned. Other columns are not read; an empty table gives
    an empty result.
    """
    got = _decided(df, key, text_col, source_col, weights, seed, classes)
    return got.select(F.col("row")[key].alias(key), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "copies", "inclusion", "rank")


def mixed(df: DataFrame, key: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix", classes: tuple[tuple[int, float], ...] = CLASSES) -> DataFrame:
    """The rows of the mix itself, all columns of ``df``, each as often as it is taken."""
    got = _decided(df, key, text_col, source_col, weights, seed, classes).where((F.col("copies") > 0) & (F.col("size") > 0))
    return got.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def oracle_sql(weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix", classes: tuple[tuple[int, float], ...] = CLASSES) -> str:
    """The query in DuckDB SQL, over ``documents``."""
    scale = f"{1 << BITS}::DOUBLE"
    odds = "".join(f" WHEN size >= {least} THEN {of}::DOUBLE" for least, of in sorted(classes, reverse=True))
    passes = "".join(f"""
    , run{p} AS (SELECT *, size > 0 AND size <= gap{p} AND NOT extra AS fits,
        sum(CASE WHEN size > 0 AND size <= gap{p} AND NOT extra THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY u) AS upto
      FROM state{p})
    , took{p} AS (SELECT * EXCLUDE (extra, fits, upto), extra OR (fits AND upto <= gap{p}) AS extra,
        gap{p} - sum(CASE WHEN fits AND upto <= gap{p} THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap{p + 1} FROM run{p})
    , state{p + 1} AS (SELECT * EXCLUDE (gap{p}) FROM took{p})""" for p in range(PASSES))
    return f"""
    WITH drawn AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, {BITS // 4}))::BIGINT AS random
      FROM documents)
    , odds AS (SELECT *, CASE{odds} END AS odds, (random + 0.5::DOUBLE) / {scale} AS x,
        ({scale} - random - 0.5::DOUBLE) / {scale} AS rest FROM drawn)
    , docs AS (SELECT doc_id, source, size, least(floor(x / (x + odds * rest) * {scale})::BIGINT, {(1 << BITS) - 1}) AS u FROM odds)
    , totals AS (SELECT source, sum(size)::BIGINT AS source_size,
        [{', '.join(map(str, weights))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS w
      FROM docs GROUP BY source)
    , levels AS (SELECT *, {MOST_COPIES} * source_size AS cap,
        (sum(source_size) OVER () - coalesce(sum({MOST_COPIES} * source_size) OVER (
            ORDER BY {MOST_COPIES} * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(w) OVER (ORDER BY {MOST_COPIES} * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        AS level FROM totals)
    , leveled AS (SELECT source, source_size, w, cap, max(CASE WHEN level * w < cap THEN level END) OVER () AS level FROM levels)
    , goals AS (SELECT source, source_size,
        CASE WHEN level * w < cap THEN level * w ELSE cap::DOUBLE END AS target FROM leveled)
    , state0 AS (SELECT d.*, g.source_size, g.target, coalesce(floor(g.target / nullif(g.source_size, 0)), 0)::BIGINT AS whole,
        coalesce(g.target - floor(g.target / nullif(g.source_size, 0)) * g.source_size, 0) AS gap0, false AS extra
      FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source){passes}
    , ranked AS (SELECT *, NOT extra AND size > 0 AND abs(size - gap{PASSES}) < gap{PASSES} AS nearer,
        rank() OVER (PARTITION BY source, NOT extra AND size > 0 AND abs(size - gap{PASSES}) < gap{PASSES}
          ORDER BY abs(size - gap{PASSES}), u, size) AS place FROM state{PASSES})
    SELECT doc_id, size, source_size, target, size * (whole + (extra OR (nearer AND place = 1))::BIGINT) AS taken FROM ranked"""
