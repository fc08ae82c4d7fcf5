import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from quarry.operators import text as T
from quarry.plans.common_words import common_words_job
from quarry.session import scratch_path
from quarry.sources import text as io


def lines_df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_space_tokenizer_literals(spark):
    cases = {"": [""], " ": [], "a  b ": ["a", "", "b"], " a": ["", "a"]}
    for line, expected in cases.items():
        got = [r.word for r in T.tokenize(lines_df(spark, [line]), "space").collect()]
        assert got == expected, line


def test_whitespace_tokenizer_drops_empties_and_keeps_case(spark):
    df = lines_df(spark, ["  The cat\tsat\n\n on\fthe\rMat  ", "", "\x0bx"])
    assert sorted(r.word for r in T.tokenize(df, "whitespace").collect()) == \
        sorted(["The", "cat", "sat", "on", "the", "Mat", "\x0bx"])


def test_lines_of_text_like_a_line_reader(spark):
    df = spark.createDataFrame([(1, "a\nb\r\nc\rd\n"), (2, ""), (3, "x\n\ny")], "doc_id int, text string")
    got = rows(io.lines_of(df, keep=("doc_id",)), "doc_id", "value")
    assert got == sorted([(1, "a"), (1, "b"), (1, "c"), (1, "d"), (3, "x"), (3, ""), (3, "y")])


def test_stopwords_fold_vs_exact(spark):
    toks = T.tokenize(lines_df(spark, ["The the THE of x"]), "whitespace")
    stop = ["The", "of"]
    fold = sorted(r.word for r in T.remove_stopwords(toks, stop, "fold").collect())
    exact = sorted(r.word for r in T.remove_stopwords(toks, stop, "exact").collect())
    assert fold == ["x"]
    assert exact == sorted(["the", "THE", "x"])
    # same result through the DataFrame (file) path
    sdf = T.stopword_table(spark, stop, fold=False)
    assert sorted(r.word for r in T.remove_stopwords(toks, sdf, "fold").collect()) == fold
    assert sorted(r.word for r in T.remove_stopwords(toks, sdf, "exact").collect()) == exact


def test_common_words_literal(spark):
    a = spark.createDataFrame([("x", 3), ("y", 1)], "word string, n bigint")
    b = spark.createDataFrame([("x", 2), ("z", 9)], "word string, n bigint")
    assert rows(T.common_words(a, b)) == [("x", 2)]
    assert rows(T.common_words(a, b, "union")) == [("x", 2)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "d", "The", "of", "x y"]), min_size=0, max_size=30),
       st.lists(st.sampled_from(["a", "b", "c", "e", "THE", "x", "y"]), min_size=0, max_size=30))
def test_join_equals_union_and_topk_is_prefix(spark, la, lb):
    A, B = lines_df(spark, la), lines_df(spark, lb)
    stop = ["The", "of"]
    j = rows(common_words_job(A, B, stop, n=None, strategy="join"))
    u = rows(common_words_job(A, B, stop, n=None, strategy="union"))
    assert j == u
    full = sorted(j, key=lambda r: (-r[1], r[0]))
    top = [tuple(r) for r in common_words_job(A, B, stop, n=3).collect()]
    assert top == full[:3]


def test_kv_roundtrip_keeps_bytes(spark):
    words = ['he"llo', '"q', "", "a\\b", "#x", "tab\tin"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n bigint")
    path = scratch_path(spark, "kvtest")
    io.write_kv(df, path, "word", "n")
    back = rows(io.read_kv(spark, path))
    # a tab inside the key moves the split point: key is what precedes the first tab
    expected = sorted([(w, str(i)) for i, w in enumerate(words) if "\t" not in w] + [("tab", "in\t5")])
    assert back == expected


def test_write_modes(spark):
    df = spark.createDataFrame([("a", 1)], "word string, n bigint")
    path = scratch_path(spark, "modes")
    io.write_tuples(df, path, "word", "n")
    assert [r.value for r in spark.read.text(path).collect()] == ["(a,1)"]
    try:
        io.write_tuples(df, path, "word", "n")  # default: fail if present
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "already exists" in str(e).lower() or "path" in str(e).lower()
    io.write_kv(df, path, "word", "n", overwrite=True)
    assert [r.value for r in spark.read.text(path).collect()] == ["a\t1"]


def test_dir_tag(spark):
    base = scratch_path(spark, "tag")
    io.write_lines(lines_df(spark, ["a", "b"]), f"{base}/one")
    io.write_lines(lines_df(spark, ["c"]), f"{base}/two")
    df = io.read_lines(spark, f"{base}/one", f"{base}/two", tag="dir")
    assert rows(df.groupBy("tag").count()) == [("one", 2), ("two", 1)]


def test_partition_independence_common_words(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["The", "of"]
    la = [" ".join(rnd.choice(vocab) for _ in range(12)) for _ in range(60)]
    lb = [" ".join(rnd.choice(vocab) for _ in range(12)) for _ in range(60)]
    out = []
    for parts in (1, 3, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        A = lines_df(spark, la).repartition(parts)
        B = lines_df(spark, lb).repartition(parts)
        out.append([tuple(r) for r in common_words_job(A, B, ["The"], n=15).collect()])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] == out[2]


def test_plan_is_top_k_with_partial_aggregates(spark, capsys):
    A = lines_df(spark, ["a b c", "a"])
    B = lines_df(spark, ["a c"])
    common_words_job(A, B, ["x", "y"], n=15).explain()
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan
    assert "IN (" in plan.upper() or "INSET" in plan.upper()


def test_null_key_and_value_round_trip_as_empty(spark):
    from quarry.session import scratch_path
    from quarry.sources.text import read_kv, write_kv
    path = scratch_path(spark, "kv-null")
    write_kv(spark.createDataFrame([(None, 1), ("a", None)], "k string, v int"), path, "k", "v")
    assert rows(read_kv(spark, path)) == [("", "1"), ("a", "")]


def test_space_tokens_can_leave_empty_ones_out(spark):
    from quarry.operators import text as T
    lines = spark.createDataFrame([(" a  b ",), ("",)], "value string")
    assert rows(T.tokenize(lines, "space", drop_empty=True)) == [("a",), ("b",)]


@pytest.mark.parametrize("mode", ["whitespace", "space"])
def test_word_count_by_text_is_the_count_of_all_tokens(spark, mode):
    """Texts with a key of their own are counted without a shuffle of words; repeated and null keys are added up."""
    texts = ["b a  b\nB\r\n\r\na ", "", "\n", " \n  x", None, "a\tb\x0ba\x0c\r\rb", "\u03a3\u0391\u03a3 \u03c3", "end\r\n", "x\n\r", "\u00a0 \u00a0"]
    data = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (3, "x y"), (None, "n a"), (None, "a")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = Counter()
    for key, text in data:
        lines = [] if not text else re.split("\r\n|\r|\n", re.sub("(\r\n|\r|\n)\\Z", "", text))
        for line in lines:
            if mode == "whitespace":
                words = [w for w in re.split("[ \t\n\r\f]+", line) if w]
            else:
                words = [""] if line == "" else [w.lower() for w in line.rstrip(" ").split(" ")] if line.strip(" ") else []
            want.update((key, w) for w in words)
    got = T.word_count_by_text(df, "doc_id", mode, lower=mode == "space")
    assert Counter({(r.doc_id, r.word): r.n for r in got.collect()}) == want and got.count() == len(want)
    own = T.word_count_by_text(df.where("doc_id > 3"), "doc_id", mode)
    assert [f.dataType.simpleString() for f in own.schema] == ["bigint", "string", "bigint"]
