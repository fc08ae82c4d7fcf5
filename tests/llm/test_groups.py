"""Operators that bring rows together: against brute force, on odd tables and on hot groups."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from quarry.llm import ann, line_dedup, mixing, simhash
from quarry.llm.common import table
from quarry.llm.components import connected_components
from quarry.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL, rows
from tests.llm.test_rows import odd_docs, texts


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    df = spark.createDataFrame([*edges, (None, 3), (7, 7), (1, 0)], "a long, b long")
    want = components({x for e in edges if e[0] != e[1] for x in e}, edges)
    assert dict(rows(connected_components(df))) == want
    assert connected_components(df.limit(0)).count() == 0


# --------------------------------------------------------------------------- SimHash

def fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if grams else 0


def test_near_duplicates_against_all_pairs(spark):
    docs = texts(spark)
    fps = {i: fingerprint(t) for i, t in docs.items()}
    linked = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = components(fps, linked)
    got = QUERIES["op8_simhash_near_dedup"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


@pytest.mark.parametrize("tree", [4096, 7])
def test_links_in_a_hot_shard_are_complete(spark, tree):
    rng = random.Random(tree)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(60)} | {rng.getrandbits(64) for _ in range(30)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    edges = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    want = components({simhash.signed(f) for f in fps}, [(simhash.signed(a), simhash.signed(b)) for a, b in edges])
    found = simhash.links(df, 3, tree).collect()
    got = components({simhash.signed(f) for f in fps}, [(r.a, r.b) for r in found])
    assert got == want


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(5)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    xs = [rng.getrandbits(12) for _ in range(50)]
    want = {(x, v) for x in xs for v in values if 0 < (x ^ v).bit_count() <= 3}
    assert set(tree.pairs(xs, 3)) == want
    assert {(x, y) for x in xs for y in tree.within(x, 3)} == want


def test_simhash_of_odd_rows(spark):
    docs = odd_docs(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    zero = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {0}  # empty texts, and the null one, are one component
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert left.count() == len({r.component_id for r in got})
    assert left.where("doc_id = 3").count() == 1  # of equal rows one stays
    nulls = docs.where("doc_id is null")
    assert simhash.near_duplicates(nulls).first().component_id is None and simhash.one_of_each(nulls).count() == 1


# --------------------------------------------------------------------------- lines

def similar(a, b):
    """Edit similarity of at least the limit."""
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1] <= math.floor(max(len(a), len(b)) * (1 - line_dedup.SIMILARITY) + 1e-9)


def norm(line):
    return regex.sub(r"[^\p{L}\p{M}\p{N}]+", " ", line).strip().lower() or " ".join(line.split()).lower()


def brute_lines(docs):
    """docs: (key, text) in order of key. Removed (key, line) by edit similarity alone, over all pairs."""
    occurrences = defaultdict(list)
    for key, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            if norm(line):
                occurrences[norm(line)].append((key, n))
    lines, edges = sorted(occurrences), []
    bags = [Counter(x) for x in lines]
    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            most = max(len(a), len(b))
            # an edit changes one character of either bag at most
            if (min(len(a), len(b)) >= line_dedup.SIMILARITY * most and (bags[i] & bags[j]).total() >= line_dedup.SIMILARITY * most - 1e-6
                    and similar(a, b)):
                edges.append((i, j))
    groups = defaultdict(list)
    for i, root in components(range(len(lines)), edges).items():
        groups[root] += occurrences[lines[i]]
    return {place for g in groups.values() for place in sorted(g)[1:]}


def within(part, whole):
    """Whether the lines of ``part`` are lines of ``whole`` in this order."""
    rest = iter(whole)
    return all(x in rest for x in part)


def check_lines(before, after, gone, recall=0.9):
    """before, after: texts by key. What edit similarity keeps stays, and at least ``recall`` of the other lines go."""
    removed = 0
    for key, text in before.items():
        if text is None:
            assert after[key] is None
            continue
        lines, left = text.split("\n"), after[key].split("\n") if after[key] or len(text.split("\n")) > 1 else [after[key]]
        must = [x for n, x in enumerate(lines) if (key, n) not in gone]
        assert within(must, left) or not any(x.strip() for x in must), key
        assert within(left, lines) or left == [""], key
        removed += len(lines) - (len(left) if after[key] or left == lines else 0)
    assert removed >= recall * len(gone), (removed, len(gone))


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(5000):04d}" for _ in range(400)]
    lines = [" ".join(rng.choices(words, k=rng.randint(8, 30))) for _ in range(40)]
    near = []
    for line in lines[:20]:  # variants of one to three words, and variants of these
        for _ in range(4):
            part = line.split(" ")
            for _ in range(rng.randint(1, 3)):
                part[rng.randrange(len(part))] = rng.choice(words)
            near.append("  ".join(part).upper() if rng.random() < 0.3 else " ".join(part))
    pool = lines + near + ["", "short one", "Short,  one!", "| | |", "|  | |"] + [" | ".join(rng.choices(words, k=9)) for _ in range(8)]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 6)))) for i in range(60)] + [(90, None), (91, ""), (92, "\n \n")]
    removed = brute_lines(docs)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, line string, removed int")
    got = {r.doc_id: r for r in line_dedup.dedup(df).select("row.*", "n_lines", "n_removed").collect()}
    assert len(got) == len(docs) and len(removed) > 60
    check_lines(dict(docs), {i: r.text for i, r in got.items()}, removed)
    assert 0.9 * len(removed) <= sum(r.n_removed for r in got.values()) <= len(removed)
    assert (got[90].n_lines, got[91].n_lines, got[92].n_lines) == (0, 0, 0)
    assert got[1].line == "x" and got[1].removed == 1


def test_line_dedup_of_odd_rows(spark):
    docs = odd_docs(spark)
    got = line_dedup.dedup(docs).select("row.*", "n_lines", "n_removed")
    assert got.count() == docs.count()
    assert got.where("doc_id = 3").select("text").distinct().count() == 1  # equal rows share one outcome
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def test_line_dedup_finds_what_edit_similarity_alone_links(spark):
    """Pairs of one changed word or of typos, by length of the line: nothing but the edits decides what is linked."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(6000)]
    pairs = []
    for n in (1, 2, 3, 4, 6, 8, 10, 14, 20, 50):
        made = 0
        while made < 40:
            part = rng.choices(words, k=n)
            other = list(part)
            at = rng.randrange(n)
            if made % 2 and n > 2:
                other[at] = rng.choice(words)
            else:
                cut = rng.randrange(len(other[at]))
                other[at] = other[at][:cut] + rng.choice("0123456789") + other[at][cut + 1:]
            a, b = " ".join(part), " ".join(other)
            if a != b and similar(a, b):
                pairs.append((n, a, b))
                made += 1
    df = spark.createDataFrame([(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p[1:])], "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.dedup(df).where("n_removed > 0").select("row.doc_id").collect()}
    found = defaultdict(list)
    for i, (n, *_) in enumerate(pairs):
        found[n].append(2 * i + 1 in gone)
    recall = {n: sum(x) / len(x) for n, x in found.items()}
    assert min(recall.values()) >= 0.9 and sum(map(sum, found.values())) >= 0.97 * len(pairs), recall


@pytest.mark.parametrize("every", [1, 2, 3, 5])
def test_line_dedup_finds_lines_with_typos_all_over(spark, every):
    """One character replaced in every word, every second, third and fifth one, by length of the line."""
    rng = random.Random(every)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.choice([5, 6, 7, 8, 9]))) for _ in range(6000)]
    pairs = []
    for n in (4, 5, 6, 10, 12, 14, 20, 30, 60):
        for _ in range(40):
            part = rng.choices(words, k=n)
            other = [w[:c] + rng.choice("0123456789") + w[c + 1:] if i % every == 0 else w
                     for i, w in enumerate(part) for c in [rng.randrange(len(w))]]
            pairs.append((n, " ".join(part), " ".join(other)))
    assert all(similar(a, b) for n, a, b in pairs if n < 20)
    df = spark.createDataFrame([(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p[1:])], "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.dedup(df).where("n_removed > 0").select("row.doc_id").collect()}
    assert all(i % 2 for i in gone)
    found = defaultdict(list)
    for i, (n, *_) in enumerate(pairs):
        found[n].append(2 * i + 1 in gone)
    recall = {n: sum(x) / len(x) for n, x in found.items()}
    assert min(recall.values()) >= 0.9, recall


def test_line_words_and_their_simhash(spark):
    lines = [" ".join("x" * (i % 9 + 1) + str(i) for i in range(n)) for n in (1, 2, 7, 8, 63, 300)] + ["same same same same"]
    df = line_dedup.with_words(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, line string"))
    shapes = set()
    for r in df.withColumn("fp", line_dedup.simhash(F.col("top"))).collect():
        words, top = lines[r.i].split(" "), [None] * line_dedup.CLASSES
        for at, w in enumerate(words):
            h = xxhash.xxh64_intdigest(w, 42)
            c = h % line_dedup.CLASSES
            top[c] = max(top[c] or 0, (len(w) << 56) | (h >> 24 << 16) | at)
        assert (r.n_words, r.top) == (len(words), top)
        hashes = [xxhash.xxh64_intdigest((i if top[i] is None else top[i] >> 16).to_bytes(8, "little"), 42) for i in range(7)]
        assert r.fp == simhash.signed(sum((2 * sum(h >> b & 1 for h in hashes) > 7) << b for b in range(64)))
        shapes.add(r.shape)
    assert len(shapes) == len(lines)


def test_lines_are_compared_without_what_they_share(spark):
    rng = random.Random(6)
    cases = [([rng.choice("abc") for _ in range(rng.randint(1, 6))], [rng.choice("abc") for _ in range(rng.randint(1, 6))]) for _ in range(300)]
    df = spark.createDataFrame([(i, u, v, " ".join(u), " ".join(v)) for i, (u, v) in enumerate(cases)], "i int, u array<string>, v array<string>, a string, b string")
    got = df.select("i", line_dedup.apart(F.col("u"), F.col("v")).alias("s"), *(line_dedup.near(F.col("a"), F.col("b"), F.lit(n)).alias(f"n{n}") for n in range(5)),
                    F.levenshtein("a", "b").alias("edits"))
    for r in got.collect():
        u, v = cases[r.i]
        while u and v and u[0] == v[0]:
            u, v = u[1:], v[1:]
        while u and v and u[-1] == v[-1]:
            u, v = u[:-1], v[:-1]
        assert (r.s.u, r.s.v) == (u, v)
        assert [r[f"n{n}"] for n in range(5)] == [r.edits <= n for n in range(5)]


def test_pairs_of_a_large_bucket_do_not_grow_with_its_square(spark, monkeypatch):
    """Lines that share six long words but stay unconnected: the last step compares a few with each, not all pairs."""
    rng = random.Random(8)
    common = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(6)]
    lines = [" ".join(common + ["".join(rng.choices("klmnopqrst", k=5)) for _ in range(8)]) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    met = []

    def none_similar(pairs, *_):
        met.append(pairs.count())
        return pairs.limit(0)
    monkeypatch.setattr(line_dedup, "verified", none_similar)
    line_dedup.dedup(df).count()
    assert len(lines) < met[-1] <= 2 * line_dedup.NEXT * len(lines), met


def test_buckets_of_the_same_lines_are_held_once(spark):
    """Near copies share most of their keys: one bucket of the same lines is kept, and every bucket of other ones."""
    buckets = {1: (5, 6, 7), 2: (5, 6, 7), 3: (5, 6, 8), 4: (5, 6, 7, 8), 5: (6, 7, 8), 6: (5, 6, 7)}
    held = spark.createDataFrame([(b, min(x), i) for b, x in buckets.items() for i in x], "bucket long, first long, id long")
    left = defaultdict(list)
    for r in line_dedup.different(held).collect():
        left[r.bucket].append(r.id)
    assert sorted(tuple(sorted(x)) for x in left.values()) == sorted(set(buckets.values()))


def test_a_first_limit_of_edits_changes_no_verdict(spark):
    rng = random.Random(9)
    cases = [(" ".join(rng.choice("abc") for _ in range(rng.randint(1, 6))), " ".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))) for _ in range(100)]
    df = spark.createDataFrame(cases, "a string, b string")
    got = df.select(F.levenshtein("a", "b").alias("edits"), *(line_dedup.near(F.col("a"), F.col("b"), F.lit(3), F.lit(n)).alias(f"n{n}") for n in (0, 2, 9)))
    assert all(r[f"n{n}"] == (r.edits <= 3) for r in got.collect() for n in (0, 2, 9))


def test_neighbours_in_small_and_large_buckets(spark):
    near, words = line_dedup.NEXT, [[c << 16 for c in range(line_dedup.CLASSES)] for _ in range(60)]
    words[10][3] = words[50][3] = 99 << 16  # in the large bucket these two alone have a word more in common
    small = [(1, i, i // 2, 100 + i, near, [None] * line_dedup.CLASSES) for i in range(near)]
    large = [(2, 100 + i, 100 + i, 1000 + i, 60, w) for i, w in enumerate(words)]
    df = spark.createDataFrame(small + large, "bucket long, id long, label long, n int, members long, top array<long>")
    got = {tuple(r) for r in line_dedup.neighbours(df).collect()}
    assert {(a, b) for a, b in got if a < 100} == {(a, b) for a in range(near) for b in range(a) if a // 2 != b // 2}
    assert (150, 110) in got and all((101 + i, 100 + i) in got for i in range(59))
    assert len(got) <= near * (line_dedup.CLASSES + 1) * (len(small) + len(large))


def test_neighbours_leave_out_only_pairs_that_are_not_alike(spark):
    """What the last step writes is what may be alike: all pairs that are, and hardly any other."""
    rng = random.Random(5)
    common = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(3)]
    lines = [" ".join([*common[:rng.randint(0, 3)], *("".join(rng.choices("klmnopqrst", k=9)) for _ in range(rng.randint(8, 12)))]) for _ in range(300)]
    df = spark.createDataFrame([(7, i, i, 300, len(x), x) for i, x in enumerate(lines)], "bucket long, id long, label long, members long, n int, line string")
    known = ("n", "n_words", "shape", "sketch")
    rest = line_dedup.with_words(df).withColumn("sketch", line_dedup.sketch(F.col("top"))).cache()
    every, some = (line_dedup.neighbours(rest, *extra) for extra in ((), (known, line_dedup.maybe_alike)))
    both = every
    for x in "ab":
        both = both.join(rest.select(F.col("id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "n_words", "shape", "top"))), x)
    alike = {tuple(r) for r in both.where((F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * line_dedup.SIMILARITY) & line_dedup.alike()).select("a", "b").collect()}
    some = {tuple(r) for r in some.collect()}
    assert alike and alike <= some and len(some) <= 1.05 * len(alike) < 0.8 * every.count(), (len(alike), len(some), every.count())


def test_all_lines_of_a_large_bucket_meet_across_its_groups(spark, monkeypatch):
    """In cells and in turns: every pair of lines of different groups that is alike, once, and no other."""
    monkeypatch.setattr(line_dedup, "CELL", 40)
    rng = random.Random(12)
    common = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(4)]
    lines = [" ".join([*common[:rng.randint(1, 4)], *("".join(rng.choices("klmnopqrst", k=9)) for _ in range(rng.randint(6, 14)))]) for _ in range(300)]
    rows = [(7 + i % 2, i, i // 3, 150, len(x), x) for i, x in enumerate(lines)]
    df = line_dedup.with_words(spark.createDataFrame(rows, "bucket long, id long, label long, members long, n int, line string"))
    df = df.withColumn("sketch", line_dedup.sketch(F.col("top"))).cache()
    sides = [df.select("bucket", *(F.col(c).alias(f"{c}_{x}") for c in ("id", "label", "n", "n_words", "shape", "top"))) for x in "ab"]
    want = sides[0].join(sides[1], "bucket").where("id_a > id_b AND label_a <> label_b").where(
        (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * line_dedup.SIMILARITY) & line_dedup.alike()).select("id_a", "id_b")
    want = {tuple(r) for r in want.collect()}
    turns = [[tuple(r) for r in line_dedup.all_across(df, turn, 3).collect()] for turn in range(3)]
    assert all(turns) and len(want) > 1000 and sorted(sum(turns, [])) == sorted(want) == sorted(tuple(r) for r in line_dedup.all_across(df).collect())


def test_line_dedup_links_lines_far_apart_in_a_large_bucket(spark):
    """Lines that share six long words; those that are near each other have nothing more in common, and many stand between them."""
    rng = random.Random(14)
    common = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(6)]
    lines = [[*common, *("".join(rng.choices("klmnopqrstuvwxyz", k=6)) for _ in range(14))] for _ in range(150)]
    near = [[*x[:6], *(w[:c] + rng.choice("0123456789") + w[c + 1:] for w in x[6:] for c in [rng.randrange(6)])] for x in lines[:30]]
    docs = [(i, " ".join(x)) for i, x in enumerate(lines + near)]
    gone = {r.doc_id for r in line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string")).where("n_removed > 0").select("row.doc_id").collect()}
    assert gone == set(range(150, 180))


def test_edits_by_words_are_enough(spark):
    """What the alignment of words says is never less than the edits, and little more for lines that lost and got words."""
    rng = random.Random(15)
    cases = [([rng.choice("abcd") * rng.randint(1, 4) for _ in range(rng.randint(0, 9))], [rng.choice("abcd") * rng.randint(1, 4) for _ in range(rng.randint(0, 9))]) for _ in range(300)]
    for _ in range(50):
        u = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60)]
        v = [x for i, w in enumerate(u) for x in ([] if i % 20 == 3 else ["new", w] if i % 20 == 9 else ["other"] if i % 20 == 15 else [w])]
        cases.append((u, v))
    spelt = lambda words: "".join(f" {w}" for w in words)
    df = spark.createDataFrame([(i, u, v, spelt(u), spelt(v)) for i, (u, v) in enumerate(cases)], "i int, u array<string>, v array<string>, a string, b string")
    got = df.select("i", line_dedup.by_words(F.struct("u", "v")).alias("enough"), F.levenshtein("a", "b").alias("edits")).collect()
    assert len(got) == len(cases) and all(r.enough >= r.edits for r in got)
    assert all(r.enough <= 80 for r in got if r.i >= 300) and sum(r.enough for r in got) < 2 * sum(r.edits for r in got)


def test_lines_are_read_and_removed_without_a_broadcast(spark, monkeypatch):
    """Beyond the limit of a broadcast texts are shuffled, of which only those that are asked for; the rows are the same."""
    rng = random.Random(16)
    lines = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(12)) for _ in range(40)]
    docs = [(i if i % 7 else None, "\n".join(rng.choices(lines, k=3)) + ("x" if i % 3 else "")) for i in range(60)] + [(None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = Counter(tuple(r) for r in line_dedup.dedup(df).select("row.*", "n_removed").collect())
    places = spark.createDataFrame([(i, i) for i in range(20)], "doc long, id long")
    texts = spark.createDataFrame([(i, str(i)) for i in range(90)], "text_is long, text string")
    for limit in (1000, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST", limit)
        assert line_dedup.with_only(texts, places).count() == (20 if limit else 90)
    plan = texts.join(line_dedup.beside(places), F.col("text_is") == F.col("doc"))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
    assert Counter(tuple(r) for r in line_dedup.dedup(df).select("row.*", "n_removed").collect()) == want


# --------------------------------------------------------------------------- mixing

def test_mixing_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(con.execute(SQL["op4_mixing"]).fetchall())
    assert rows(QUERIES["op4_mixing"](spark, SF_SMALL)) == want


def test_mixing_nears_its_targets_and_reruns_agree(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id")
    assert got.where("taken > 3 * size or taken < 0").count() == 0
    per = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.06 * r.target for r in per)
    assert abs(sum(r.taken for r in per) / sum(r.target for r in per) - 1) < 0.02
    other = mixing.mix(docs.repartition(5, "n_chars")).select("doc_id", "taken")
    assert rows(other) == rows(got, "doc_id", "taken")


def test_mixing_includes_by_the_stated_odds(spark):
    # sources of three size classes: a class is included as often as the odds of its documents say, but for the small
    # documents that fill up the gap a larger one left, about one document's worth of words a source
    rng = random.Random(4)
    docs = spark.createDataFrame([(1000 * s + i, " ".join(["w"] * rng.choice([20, 20, 60, 60, 300])), f"{s:02}") for s in range(8) for i in range(600)],
                                 "doc_id long, text string, source string")
    hits, odds, n = Counter(), defaultdict(float), Counter()
    for r in mixing.mix(docs).collect():
        n[r.size] += 1
        odds[r.size] += r.inclusion
        hits[r.size] += r.copies - int(r.target // r.source_size)
        assert 0 <= r.inclusion <= 1
    assert odds[20] / n[20] < odds[60] / n[60] < odds[300] / n[300]
    assert all(abs(hits[k] - odds[k]) < 0.07 * n[k] for k in n), (hits, odds, n)


def test_mixing_selects_the_first_pareto_ranks(spark):
    docs = table(spark, SF_SMALL, "documents")
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    by_source = defaultdict(list)
    for r in got:
        if r.size and r["rank"] is not None:
            by_source[r.source].append((r["rank"], r.size, r.copies - int(r.target // r.source_size), r.target % r.source_size))
    for members in by_source.values():
        used = 0
        for _, size, extra, gap in sorted(members):
            if size > gap:
                continue
            used += size
            if used > gap:
                break
            assert extra == 1


def test_mixing_of_odd_sources(spark):
    docs = odd_docs(spark).union(spark.createDataFrame([(50 + i, "one two three", None, s, 1, "k", 2) for i, s in enumerate(["a", "a", None, "Z", "é"])],
                                                       odd_docs(spark).schema))
    got = mixing.mix(docs)
    assert got.count() == docs.count()
    assert got.where("target > 3 * source_size").count() == 0
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns
    assert copies.count() == got.where("size > 0").agg(F.sum("copies")).first()[0]
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


# --------------------------------------------------------------------------- neighbours

def nearest(vectors, k=20):
    """Every query row's list over all other rows, by id; shorter vectors are filled up with zeros."""
    dim = max(len(v) for _, v in vectors)
    x = np.array([[*v, *[0.0] * (dim - len(v))] for _, v in vectors], float)
    out = {}
    for at, (i, _) in enumerate(vectors):
        if i is not None and i % 20 == 0:
            score = x @ x[at]
            order = sorted((j for j in range(len(vectors)) if j != at),
                           key=lambda j: (-score[j], vectors[j][0] is None, vectors[j][0] or 0))[:k]
            out[i] = [(vectors[j][0], float(score[j])) for j in order]
    return out


def lists(df):
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def test_neighbours_of_all_embeddings(spark):
    vectors = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    want, got = nearest(vectors), lists(QUERIES["op10_nearest_neighbours"](spark, SF_SMALL))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == 20 and all(a[1] >= b[1] for a, b in zip(found, found[1:]))


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(size=4).tolist()) for i in range(30)] + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]
    vectors += [(240, [1.0, 2.0]), (None, [1.0] * 4), (280, [3.0, -1.0, 0.5, 0.25, 7.0]), (7, [9.0, 0.0, 0.0, 1.0])]
    bad = [(40, None), (60, [0.0] * 4), (80, [1.0, None, 2.0, 3.0]), (200, [float("nan")] + [1.0] * 3), (220, [float("inf")] + [1.0] * 3),
           (260, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in [*vectors, *bad]], "vec_id long, embedding array<double>, rank int")
    got, want = lists(ann.nearest(df, F.col("id") % 20 == 0)), nearest(vectors)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)
    few = lists(ann.nearest(df.where("vec_id in (0, 1, 2)"), F.col("id") % 20 == 0))
    assert {q: len(x) for q, x in few.items()} == {0: 2}
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert ann.nearest(df.where("vec_id = 1"), F.col("id") % 20 == 0).count() == 0
    zero = df.where("vec_id = 0")
    twice = sorted(map(tuple, ann.nearest(zero.union(zero), F.col("id") % 20 == 0).select("query_id", "rank", "vec_id").collect()))
    assert twice == [(0, 1, 0), (0, 1, 0)]  # each of two equal rows finds the other


@pytest.mark.parametrize("size", [1e155, 1e-170, 1e300])
def test_neighbours_beyond_the_range_of_doubles(spark, size):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6))
    df = spark.createDataFrame([(i, (v * size).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, want = lists(ann.nearest(df, F.col("id") % 20 == 0)), nearest(list(enumerate(x.tolist())))
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want) >= 0.9 * 20 * len(want)
    assert {s for found in got.values() for _, s in found} <= ({0.0} if size < 1 else {float("inf")})


def test_neighbours_of_a_tiny_query_among_large_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5))
    x[::20] *= 1e-60
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, want = lists(ann.nearest(df, F.col("id") % 20 == 0)), nearest(list(enumerate(x.tolist())))
    assert got.keys() == want.keys()
    assert sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_neighbours_within_a_group_of_near_copies(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=64)
    x = centre / np.linalg.norm(centre) + 0.01 * rng.normal(size=(1200, 64)) / 8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in ann.nearest(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in range(0, 1200, 20):
        score = x @ x[q]
        score[q] = -np.inf
        hits.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9, np.mean(hits)
