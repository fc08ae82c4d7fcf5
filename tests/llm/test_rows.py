"""Operators that judge each row by itself: against the libraries, brute force and planted cases."""

import itertools
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import chat_format, html_extract, langid, packing, quality, token_counts
from quarry.llm.common import table
from quarry.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n \n", "a<|endoftext|>b <|startoftext|>", "İstanbul ẞ ſ ǅ ΑΣ x y\x85z\x1cw\x0bq", "it's don't 12,34 it'S",
       "é 가 中文字 русский 👍🏽‍👩", "a\r\nb\tc", " lead", "trail ", "two  spaces", "one\n\ntwo", "x" * 3000, "word " * 4000, "'s't'"]


def odd_docs(spark):
    """Nulls, empty and long texts, repeats, and columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", 1, "k", 2) for i, t in enumerate(ODD)] + [(None, None, None, None, None, None, None), (3, ODD[3], "en", "s", 1, "k", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens long, kept string, size long")


def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents", "doc_id", "text").collect()}


# --------------------------------------------------------------------------- token counts

def test_token_counts_are_the_librarys(spark):
    tok, docs = Tokenizer.from_file(WORD_BPE), texts(spark)
    got = {r.doc_id: r for r in QUERIES["op9_token_counts"](spark, SF_SMALL).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 2048)


def test_token_counts_of_odd_texts(spark):
    tok = Tokenizer.from_file(WORD_BPE)
    got = token_counts.token_counts(odd_docs(spark), WORD_BPE).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = "" if r.doc_id is None else ODD[r.doc_id]
        assert r.n_tokens == len(tok.encode(text, add_special_tokens=False).ids), repr(text[:40])
    assert token_counts.token_counts(odd_docs(spark).limit(0), WORD_BPE).collect() == []


def test_whole_tokens_encode_alone_as_one():
    tok = Tokenizer.from_file(WORD_BPE)
    whole = sorted(token_counts.whole_tokens(WORD_BPE))
    assert len(whole) > 10_000
    assert all(len(tok.encode(w, add_special_tokens=False).ids) == 1 for w in whole[::97])


# --------------------------------------------------------------------------- packing

def check_packed(rows, docs, tok):
    """Every id in exactly one piece, pieces gapless in their sequences, crc and totals right."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == docs.keys()
    for i, pieces in by_doc.items():
        ids = np.array([*tok.encode(docs[i] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    return sum(r.length for r in rows) / (2048 * len(by_seq))


def test_packing_keeps_every_id(spark):
    fill = check_packed(QUERIES["op7_packing"](spark, SF_SMALL).collect(), texts(spark), Tokenizer.from_file(BYTE_BPE))
    assert fill > 0.97


def test_packing_of_odd_texts(spark):
    docs = odd_docs(spark).dropDuplicates(["doc_id"])
    rows = packing.pack(docs, BYTE_BPE).collect()
    check_packed(rows, {**dict(enumerate(ODD)), None: None}, Tokenizer.from_file(BYTE_BPE))
    twice = packing.pack(docs.union(docs), BYTE_BPE).collect()
    assert Counter((r.doc_id, r.start, r.length) for r in twice) == Counter((r.doc_id, r.start, r.length) for r in rows * 2)
    assert packing.pack(docs.limit(0), BYTE_BPE).collect() == []


def test_differencing_balances():
    assert sorted(sorted(sizes[i] for i in w) for sizes in [[8, 7, 6, 5, 4]] for w in packing.spread_into(sizes, 2)) == [[4, 5, 7], [6, 8]]
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(1, 513, rng.integers(1, 60)).tolist()
        windows = packing.balanced(sizes, 2048)
        assert sorted(itertools.chain(*windows)) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 2048 for w in windows)
    assert packing.balanced([], 2048) == []


# --------------------------------------------------------------------------- quality

def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_measures_against_brute_force(spark):
    docs = texts(spark)
    for r in QUERIES["op3_quality_rules"](spark, SF_SMALL).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(docs[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_quality_verdict_on_labelled_documents(spark):
    found = QUERIES["op3_quality_rules"](spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    rate = {r.quality: r.kept for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rate[1] > 0.95 and rate[0] < 0.1


def test_quality_of_odd_texts(spark):
    for r in quality.quality_rules(odd_docs(spark)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(
            None if r.doc_id is None else ODD[r.doc_id])
    assert quality.quality_rules(odd_docs(spark).limit(0)).collect() == []


def test_coverage_survives_hash_collisions():
    ids = np.array([0, 1, 2, 3, 4, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9])
    at = np.arange(11)
    found = quality.repeated(at, np.zeros(11, np.uint64), ids, np.zeros(15, int), 5)
    assert sorted(found.tolist()) == [0, 5]


# --------------------------------------------------------------------------- language

def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "lang").collect()}
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) > 0.98 * len(held)


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(60):
        langs, per = rng.integers(1, 4), rng.integers(0, 6, size=5)
        scores = rng.normal(size=(per.sum(), langs)) * rng.choice([1, 3, 20])
        path, at = langid.best_paths(scores, per, 6.0), 0
        for n in per:
            own = scores[at:at + n]

            def value(q):
                return sum(own[i, q[i]] for i in range(n)) - 6.0 * sum(q[i] != q[i - 1] for i in range(1, n))
            assert not n or abs(max(map(value, itertools.product(range(langs), repeat=int(n)))) - value(path[at:at + n])) < 1e-6
            at += n


def test_any_number_of_languages(spark, monkeypatch):
    # 300 languages, each of ten words of its own letters: the tables stay within their bound, nothing fails
    monkeypatch.setattr(langid, "MODEL_CELLS", 100 << 15)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def words(i):
        rng = np.random.default_rng(i)
        return " ".join("".join(letters[c] for c in rng.choice(26, size=7)) for _ in range(10))
    learn = [(i, words(i), f"l{i:03d}") for i in range(300)]
    df = spark.createDataFrame(learn, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert len(model.langs) == 300 and model.log_p[0].size <= langid.MODEL_CELLS
    got = {r.doc_id: r for r in langid.predict(df.repartition(3), model).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in learn) >= 0.98 * len(learn)
    scores = np.random.default_rng(1).normal(size=(40, 300)) * 20
    path = langid.best_paths(scores, np.array([40]), 3.0)
    reach = scores[0].copy()
    for row in scores[1:]:
        reach = row + np.maximum(reach, reach.max() - 3.0)
    value = scores[np.arange(40), path].sum() - 3.0 * (path[1:] != path[:-1]).sum()
    assert abs(value - reach.max()) < 1e-6


def test_language_of_odd_and_mixed_texts(spark):
    learn = spark.createDataFrame([("the cat sat on the mat with another thing " * 5, "en"), ("кошка сидела на окне и смотрела " * 5, "ru"),
                                   ("die katze sitzt auf der matte und schläft " * 5, "de"), (None, "de"), ("x", None)], "text string, lang string")
    model = langid.train(learn)
    assert model.langs == ["de", "en", "ru"]
    mixed = "the cat sat on the mat with another thing die katze sitzt auf der matte und schläft кошка"
    got = {r.doc_id: r for r in langid.predict(odd_docs(spark).union(
        spark.createDataFrame([(99, mixed, None, None, None, None, None)], odd_docs(spark).schema)), model).collect()}
    assert (got[None].lang_pred, got[0].lang_pred, got[0].score) == ("und", "und", 0.0)
    assert [s.lang for s in got[99].spans] == ["en", "de", "ru"]
    assert [(s.first, s.last) for s in got[99].spans] == [(0, 8), (9, 16), (17, 17)]
    nothing = langid.train(learn.limit(0))
    assert {r.lang_pred for r in langid.predict(odd_docs(spark), nothing).collect()} == {"und"}
    assert langid.predict(odd_docs(spark).limit(0), model).collect() == []


# --------------------------------------------------------------------------- pages

def test_main_text_of_pages(spark):
    import html
    raw = {r.page_id: r.html for r in table(spark, SF_SMALL, "pages").collect()}
    rows = QUERIES["op1_html_extract"](spark, SF_SMALL).collect()
    assert len(rows) == len(raw)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", raw[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())
        assert (r.text, r.n_chars) == (want, len(want))


TEMPLATE = """<html><body class="has-sidebar"><div id="wrap"><div class="site-header">Head <a href=x>l</a></div>
<ul class=m1><li><a>One</a><li><a>Two</a><li><a>Three</a></ul><div class="content post-{n}"><h2>Title &amp; more</h2>
<p>Hello <b>wor</b>ld,&nbsp; x<span class="ad">BUY</span>y<script>if(a<b)</script>z.<p>Second<br>line {n}</div>
<div class="sidebar">Side</div><div id=comments><p>Nice!</p></div><form><input>Send</form></div></body>"""


def test_planted_boilerplate_goes_and_text_stays(spark):
    pages = [(i, f"https://h.example.org/{i}", TEMPLATE.format(n=i), "x", 1) for i in range(4)]
    pages += [(10, None, "<p>No host</p><nav>Menu</nav>", "x", 1), (11, "https://h.example.org/e", "", "x", 1),
              (12, "https://h.example.org/n", None, "x", 1), (None, "not a url", "plain &lt;text&gt;", "x", 1),
              (13, "https://other.example.org/", "<div>" * 3000 + "deep", "x", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string, n_chars int")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert all(got[i] == f"Title & more Hello world, xyz. Second line {i}" for i in range(4))
    assert (got[10], got[11], got[12], got[None], got[13]) == ("No host", "", "", "plain <text>", "deep")
    plain = {r.page_id: r.text for r in html_extract.extract(df, broadcast_bytes=-1).collect()}
    assert plain == got
    assert html_extract.extract(df.limit(0)).collect() == []


def test_a_hosts_vote_outweighs_an_odd_page(spark):
    good = "<body><main class=story-{n}><p>{long}</p></main><div class=box><p>{box}</p></div>"
    pages = [(i, "http://v.example/", good.format(n=i, long="long text " * 40, box="short"), ) for i in range(8)]
    pages.append((9, "http://v.example/", good.format(n=9, long="brief story", box="a box text that is longer than it " * 3)))
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[9] == "brief story"


def test_good_text_beside_the_best_container_stays(spark):
    body = "A long running text about the thing. " * 8
    shared = "<article><div class=intro>In {n}</div><div class=body>{b}</div><div class=share>x</div></article>"
    split = ("<body><nav>Menu of many words to go elsewhere and more</nav><h1>Title {n}</h1><div class=intro>Intro {n}</div>"
             "<div class=content>{b}</div><footer>Footer of many words to go elsewhere</footer></body>")
    pages = [(10 * k + n, url and f"https://{k}.example/{n}", t.format(n=n, b=body))
             for k, (t, url) in enumerate([(shared, 1), (split, 1), (shared, None), (split, None)]) for n in range(3)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for k in (0, 2):
        assert all(got[10 * k + n] == f"In {n} {body.strip()}" for n in range(3))
    for k in (1, 3):
        assert all(got[10 * k + n] == f"Title {n} Intro {n} {body.strip()}" for n in range(3))


def test_names_of_the_layout_do_not_empty_a_page():
    body = "A long running text about the thing. " * 8
    for page in ("<body class='sidebar-right'>{}<div class=sidebar>Side</div></body>",
                 "<body><header>Head</header><div id=wrapper class='page comments-open'>{}<div id=comments>Nice!</div></div></body>",
                 "<body><form id=form1><div class=page>{}<input><label>Send</label></div></form><footer>Foot</footer></body>",
                 "<body><article class='share'>{}</article><nav>Menu</nav></body>",
                 "<body><div class=widget>{}</div></body>"):
        read = html_extract.page_of(page.format(f"<div><p>{body}</p></div>"))
        assert read.main_text(None) == body.strip(), page
    halves = html_extract.page_of(f"<body><div class=widget><p>{body}</p></div><div class=toolbar><p>{body}</p></div></body>")
    assert halves.main_text(None) == f"{body}{body}".strip()
    small = html_extract.page_of(f"<body><p>{body}</p><form><div>Your name here</div></form><div class=sidebar>Side</div></body>")
    assert small.main_text(None) == body.strip()


def test_comments_are_never_the_main_text(spark):
    story = "".join(f"<p>Sentence {k} of the story tells a little more.</p>" for k in range(4))
    want = " ".join(f"Sentence {k} of the story tells a little more." for k in range(4))
    pages = []
    for k, (box, name) in enumerate([("div", "class=comments"), ("section", "id=comment-list"), ("ul", "class='post-comments x1'"),
                                     ("div", "class='ads'"), ("div", "id=footer-content"), ("div", "class=main-menu")]):
        for n, many in enumerate((0, 10, 40, 40)):
            said = "".join(f"<div><p>Reader {j} has quite something to say about this story.</p></div>" for j in range(many))
            for m, body in enumerate((f"<div class=post>{story}</div>", f"<article>{story}</article>")):
                pages.append((100 * k + 10 * m + n, f"https://c{k}{m}.example/{n}", f"<body>{body}<{box} {name}>{said}</{box}></body>"))
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert set(got.values()) == {want}


def test_soft_names_do_not_take_text_away(spark):
    body = "A long running text about the thing that goes on for a while, and then on. "
    page = ("<body><article><p>{b}</p><p class=social>{b}</p><div class=related><a href=x>Other {n}</a> <a href=y>More</a></div>"
            "<p class=share>Share this</p></article></body>")
    results = "<body><div class=content><p>{b}</p></div><div class=search-results><p>{b}</p><p>{b}</p></div></body>"
    pages = [(10 * k + n, f"https://s{k}.example/{n}", t.format(b=body * 2, n=n)) for k, t in enumerate((page, results)) for n in range(3)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[n] == (body * 4).strip() for n in range(3))
    assert all(got[10 + n] == (body * 6).strip() for n in range(3))


# --------------------------------------------------------------------------- chats

def test_roles_of_all_conversations(spark):
    truth = {}
    for r in table(spark, SF_SMALL, "conversations").orderBy("conv_id", "turn").collect():
        truth.setdefault(r.conv_id, []).append(r.role)
    rows = QUERIES["op2_chat_format"](spark, SF_SMALL).collect()
    assert len(rows) == len(truth)
    assert sum(list(r.roles) == truth[r.conv_id] for r in rows) >= 0.95 * len(rows)


def test_chat_viterbi_against_all_paths():
    for lines in (["User: hi?", "there", "AI: yes"], ["Note: x", "hello", "Bob: y"], ["### Answer: a", "User: b", "c?"]):
        seen = [chat_format.observed(x) for x in lines]
        obs = [(k, x) for (k, _), x in zip(seen, lines)]

        def value(path):
            first = chat_format.STATES[path[0]]
            if not first[1]:
                return -np.inf
            total = np.log(chat_format.FIRST[first[0]]) + chat_format.emission(first, *obs[0])
            for i in range(1, len(path)):
                total += chat_format.TRANSITIONS[path[i]][path[i - 1]] + chat_format.emission(chat_format.STATES[path[i]], *obs[i])
            return total
        best = max(itertools.product(range(len(chat_format.STATES)), repeat=len(lines)), key=value)
        assert value(chat_format.best_path(obs)) == pytest.approx(value(best))


def test_blank_lines_inside_a_turn_stay():
    turns = chat_format.parse("\nUser: hello\n\nmore text here\n\nAssistant: one\n\n\ntwo\n\n")
    assert turns == [("user", "hello\n\nmore text here"), ("assistant", "one\n\n\ntwo")]


def test_chat_of_odd_transcripts(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "no marker at all", 0), (4, "User: hi?\nNote: this is odd\nAssistant: yes\nmore", 0), (4, "User: hi?", 0)]
    df = spark.createDataFrame(rows, "conv_id long, transcript string, turns int")
    got = sorted((r.conv_id, r.n_turns, [t.role for t in r.turns]) for r in chat_format.format_chats(df).collect())
    assert got[0] == (1, 0, []) and got[1] == (2, 0, []) and got[2][1] == 1
    assert got[4] == (4, 2, ["user", "assistant"])
    assert chat_format.format_chats(df.limit(0)).collect() == []
