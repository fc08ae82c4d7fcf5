"""Phrase collocations of every language by counting quotient filters.

1. Every task turns its texts into blocks: per language the words of up to ``BLOCK_BYTES`` of text as numbers of
   a dictionary of that block, a 0 between pieces. Blocks are saved, the texts are read once.
2. Block dictionaries are summed up to the counts of all words. A phrase of ``least`` occurrences has only words
   of as many, so just these get ids; all others break a sequence like the end of a piece. The ids go back to each
   block by a join on its own words: no vocabulary is broadcast.
3. Every task counts its 2- and 3-grams of ids in quotient filters of bounded size, split into shards by
   permuted value; shards are merged by key. A hot phrase is one counter in each filter, so shards are even.
4. Phrases of ``least`` occurrences leave the filters; scores are joins and exact decimals from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import quotient as Q
from quarry.llm.common import broadcast_if_small, by_bytes, saved

# Bytes of the text of a block; entries that a task counts before it gives its filters away.
BLOCK_BYTES, HELD = 16 << 20, 3 << 20
# Bits of the permuted value by which an exchange tells shards apart at most; beyond it shards are split anew.
LEVEL_BITS = 10
# Parts of a language that are ranked before the whole, which then has at most that many times the best phrases.
SALTS = 64
# What ends a piece, what separates words, and capital letters as small ones.
ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b"\t"
TABLE = bytes(10 if b in ENDS else 32 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCKS = "block long, part int, lang string, n_words long, wide boolean, seq binary, words array<string>, counts array<long>"


def text_blocks(df: DataFrame, text_col: str, lang_col: str, default: str) -> DataFrame:
    """The words of all texts, ``BLOCKS`` rows: one per task, block and language."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            for part, (lang, (known, seqs)) in enumerate(held.items()):
                seq = np.concatenate(seqs)
                counts = np.bincount(seq, minlength=len(known))[1:]
                wide = len(known) > 1 << 16
                yield pa.RecordBatch.from_pydict({
                    "block": [number], "part": pa.array([part], pa.int32()), "lang": [lang], "n_words": [int(counts.sum())],
                    "wide": [wide], "seq": [seq.astype("<u4" if wide else "<u2").tobytes()],
                    "words": pa.array([[w.decode() for w in list(known)[1:]]], pa.list_(pa.string())),
                    "counts": pa.array([counts.tolist()], pa.list_(pa.int64()))})
            held.clear()
            number, size = number + 1, 0

        for batch in batches:
            for part in by_bytes(batch, "__text", 2 << 20):
                texts: dict[str, list[bytes]] = {}
                for text, lang in zip(part.column("__text").to_pylist(), part.column("__lang").to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text.encode())
                for lang, parts in texts.items():
                    data = b"\n".join([*parts, b""]).translate(TABLE)
                    size += len(data)
                    tokens = [t for t in data.replace(b"\n", b" \n ").split(b" ") if t]
                    known, seqs = held.setdefault(lang, ({b"\n": 0}, []))
                    for t in dict.fromkeys(tokens):
                        known.setdefault(t, len(known))
                    seqs.append(np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens)).astype(np.uint32))
                if size >= BLOCK_BYTES:
                    yield from out()
        yield from out()

    rows = df.select(F.coalesce(F.col(text_col), F.lit("")).alias("__text"), F.coalesce(F.col(lang_col), F.lit(default)).alias("__lang"))
    return rows.mapInArrow(kernel, BLOCKS)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` (saved) with ids 1, 2, … in no particular order: places within a partition after the rows of those before it."""
    df = df.withColumn("_p", F.spark_partition_id())
    sizes = df.groupBy("_p").count().collect()  # a row per partition
    before, start = {}, 1
    for r in sorted(sizes, key=lambda r: r["_p"]):
        before[r["_p"]] = start
        start += r["count"]
    if start > 1 << 32:
        raise OverflowError("more than 2^32 - 1 frequent words")
    offsets = F.create_map(*(F.lit(x).cast("long") for kv in before.items() for x in kv)) if before else F.create_map(F.lit(0).cast("long"), F.lit(1).cast("long"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn(name, place + F.element_at(offsets, F.col("_p").cast("long"))).drop("_p")


def _count_kernel(layout: Q.Layout, shard_bits: int):
    """Blocks with their ids to encoded filters ``shard, filter``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                seq = np.frombuffer(batch.column("seq")[i].as_buffer(), "<u4" if batch.column("wide")[i].as_py() else "<u2")
                pairs = batch.column("ids")[i].values
                ids = np.zeros(batch.column("n_local")[i].as_py() + 1, np.int64)
                ids[pairs.field("local").to_numpy()] = pairs.field("id").to_numpy()
                for a in range(0, seq.size, HELD // 2):  # two words of overlap; n-grams begin in one slice only
                    part = ids[seq[a:a + HELD // 2 + 2]]
                    found = Q.counted(part, layout)
                    if a + HELD // 2 < seq.size:
                        # 2-grams among the last two words begin in the next slice
                        again = Q.counted(part[HELD // 2:], layout)
                        again.counts = -again.counts
                        found = Q.merged([found, again])
                        found = Q.Filter(found.top[found.counts > 0], None if found.low is None else found.low[found.counts > 0],
                                         found.counts[found.counts > 0])
                    parts.append(found)
                    size += len(found)
                    if size > HELD:
                        parts = [Q.merged(parts)]
                        size = len(parts[0])
                        if size > HELD // 2:
                            yield from _rows(parts[0], layout, shard_bits)
                            parts, size = [], 0
        if size:
            yield from _rows(Q.merged(parts), layout, shard_bits)

    return run


def _rows(f: Q.Filter, layout: Q.Layout, shard_bits: int) -> Iterator[pa.RecordBatch]:
    shards = Q.split(f, layout, shard_bits)
    for a in range(0, len(shards), 64):
        part = shards[a:a + 64]
        yield pa.RecordBatch.from_pydict({"shard": pa.array([s for s, _ in part], pa.int64()),
                                          "filter": [Q.encoded(g, layout, shard_bits) for _, g in part]})


def _merge_kernel(layout: Q.Layout, shard_bits: int, finer: int | None, least: int):
    """Encoded filters, sorted by shard, merged: to those of ``finer`` bits, or to frequent n-grams (None)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, last = [], 0, None

        def out(all_of_it: bool) -> Iterator[pa.RecordBatch]:
            nonlocal parts, size
            parts = [Q.merged(parts)]
            size = len(parts[0])
            if finer is not None and (all_of_it or size > HELD // 2):
                yield from _rows(parts[0], layout, finer)
            elif all_of_it:
                f = parts[0]
                often = np.flatnonzero(f.counts >= least)
                ids = layout.ids(f.top[often], None if f.low is None else f.low[often])
                yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in ids), pa.array(f.counts[often])],
                                                 names=["w1", "w2", "w3", "f"])
            if all_of_it or (finer is not None and size > HELD // 2):
                parts, size = [], 0

        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("filter")):
                if shard != last and parts:
                    yield from out(True)
                last = shard
                parts.append(Q.decoded(data.as_py(), layout, shard_bits, shard))
                size += len(parts[-1])
                if size > max(HELD, 2 * len(parts[0])):
                    yield from out(False)
        if parts:
            yield from out(True)

    return run


def frequent_ngrams(blocks: DataFrame, words: DataFrame, n_words: int, n_ids: int, least: int) -> DataFrame:
    """``w1, w2, w3, f`` of all 2- and 3-grams (w3 is 0 for two words) that occur ``least`` times, by ids."""
    spark = blocks.sparkSession
    listed = blocks.select("block", "part", "lang", F.posexplode("words").alias("local", "word"))
    ids = (listed.join(words.select("lang", "word", "id"), ["lang", "word"])
           .groupBy("block", "part").agg(F.collect_list(F.struct((F.col("local") + 1).alias("local"), "id")).alias("ids")))
    ready = blocks.select("block", "part", "seq", "wide", F.size("words").alias("n_local")).join(ids, ["block", "part"])
    layout = Q.Layout(max(2, n_ids.bit_length()))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(1, 2 * tasks, -(-2 * n_words // HELD))
    target = min((wanted - 1).bit_length(), layout.top - 1)
    levels = max(1, -(-target // LEVEL_BITS))
    shard_bits = [target * (i + 1) // levels for i in range(levels)]
    pieces = ready.select("seq", "wide", "n_local", "ids").mapInArrow(_count_kernel(layout, shard_bits[0]), "shard long, filter binary")
    for at, finer in zip(shard_bits, [*shard_bits[1:], None]):
        schema = "w1 long, w2 long, w3 long, f long" if finer is None else "shard long, filter binary"
        pieces = pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(_merge_kernel(layout, at, finer, least), schema)
    return pieces


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000,
                 default: str = "und") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two and three words of every language.

    A phrase occurs ``a`` times (at least ``least``), its language has ``n`` words, and cut where it scores
    lowest (on ties after the fewest words) its parts occur ``l`` and ``r`` times; the score is
    floor(1000000 a² / (l r)), in exact decimals up to a = 8.9e15. A two-word phrase goes if a three-word one
    around it occurs half as often. Order: score and ``a`` descending, then the phrase by bytes.

    A null text is an empty one, a null language is ``default`` and one with rows of that name. Repeated rows
    count as often as they occur; further columns are not read; an empty table gives no row.
    """
    blocks = saved(text_blocks(df, text_col, lang_col, default))
    totals = broadcast_if_small(saved(blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))), strings=("lang",))
    counted = (blocks.select("lang", F.inline(F.arrays_zip("words", "counts"))).groupBy("lang", F.col("words").alias("word"))
               .agg(F.sum("counts").alias("f")).where(F.col("f") >= least))
    words = saved(numbered(saved(counted), "id"))
    n_words, n_ids = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], words.count()
    grams = saved(frequent_ngrams(blocks, words, n_words, n_ids, least))

    two = grams.where("w3 = 0").select("w1", "w2", "f")
    three = grams.where("w3 > 0")
    by_id = broadcast_if_small(words.select("id", "lang", "word", "f"), strings=("lang", "word"))

    def word(df: DataFrame, i: int, lang: bool = False) -> DataFrame:
        names = [F.col("id").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}")]
        return df.join(by_id.select(*names, *(["lang"] if lang else [])), f"w{i}")

    def exact(l: Column, r: Column) -> Column:
        a = F.col("f").cast("decimal(19,0)")
        return F.call_function("div", (a * a).cast("decimal(38,0)") * F.lit(1000000).cast("decimal(7,0)"),
                               l.cast("decimal(19,0)") * r.cast("decimal(19,0)"))

    inside = three.select("w1", "w2", "f").union(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
    inside = inside.groupBy("w1", "w2").agg(F.max("f").alias("longer"))
    pairs = two.join(inside, ["w1", "w2"], "left").where(F.expr("longer IS NULL OR 100 * longer < 50 * f"))
    pairs = word(word(pairs, 1, lang=True), 2).select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"),
        F.col("f2").alias("r"), exact(F.col("f1"), F.col("f2")).alias("score"))
    triples = (three.join(two.select("w1", "w2", F.col("f").alias("f12")), ["w1", "w2"])
               .join(two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23")), ["w2", "w3"]))
    triples = word(word(word(triples, 1, lang=True), 2), 3)
    triples = triples.withColumn("s1", exact(F.col("f1"), F.col("f23"))).withColumn("s2", exact(F.col("f12"), F.col("f3")))
    early = F.col("s1") <= F.col("s2")
    triples = triples.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), F.col("f").alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))
    phrases = (pairs.union(triples).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
               .withColumn("_first", first).where(F.col("_first") <= top))
    ranked = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = 10, top: int = 2000) -> str:
    """DuckDB SQL for the rows of ``collocations`` over ``documents``."""
    return f"""WITH d AS (
        SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
      p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
      w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
      g AS (SELECT lang, unnest(flatten([
          list_transform(range(1, len(ws) + 1), lambda i: ws[i:i]),
          list_transform(range(1, len(ws)), lambda i: ws[i:i + 1]),
          list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])])) AS gram FROM w),
      f AS (SELECT lang, gram, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL),
      n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(gram) = 1 GROUP BY lang),
      c AS (SELECT lang, gram, f AS a FROM f WHERE len(gram) > 1 AND f >= {least}),
      cut AS (SELECT lang, gram, a, unnest(range(1, len(gram))) AS k FROM c),
      scored AS (SELECT cut.lang, cut.gram, cut.a, k, x.f AS l, y.f AS r,
          CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
        FROM cut JOIN f x ON x.lang = cut.lang AND x.gram = cut.gram[1:k]
        JOIN f y ON y.lang = cut.lang AND y.gram = cut.gram[k + 1:len(cut.gram)]),
      lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
      gone AS (SELECT DISTINCT s.lang, s.gram FROM (
          SELECT lang, gram[1:2] AS gram, a FROM c WHERE len(gram) = 3
          UNION ALL SELECT lang, gram[2:3] AS gram, a FROM c WHERE len(gram) = 3) t
        JOIN c s ON s.lang = t.lang AND s.gram = t.gram WHERE 100 * t.a >= 50 * s.a),
      named AS (SELECT o.lang, array_to_string(o.gram, ' ') AS phrase, a, l, r, score FROM lowest o
        ANTI JOIN gone ON gone.lang = o.lang AND gone.gram = o.gram),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
      SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n.n, score
      FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= {top}"""
