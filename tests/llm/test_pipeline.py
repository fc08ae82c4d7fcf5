"""The pipeline as a whole, stage by stage against what each promises."""

from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from quarry.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.llm.test_groups import components, fingerprint, norm, similar, within
from tests.llm.test_rows import brute_quality, odd_docs


def test_all_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(QUERIES) < set(names) and set(SQL) <= set(entry.oracle_sql())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, []
    for at, (_, stage) in enumerate(pipeline.STAGES):
        out = str(tmp_path / str(at))
        stage(spark, docs, SF_SMALL).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        assert at == 4 or docs.columns == columns
        seen.append((before.collect(), docs.collect()))
    before, after = seen[0]
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before if not brute_quality(r.text)[-1]} and len(kept) > 0.75 * len(before)
    before, after = seen[1]
    assert len(after) == len(before)
    kept, gone = set(), []
    left = {r.doc_id: (r.text or "").split("\n") for r in after}
    for r in before:
        rest = Counter(left[r.doc_id])
        for line in r.text.split("\n"):
            rest[line] -= 1
            (gone.append if rest[line] < 0 else kept.add)(norm(line))
    gone = [x for x in gone if x]
    assert 100 < len(gone) and all(within(left[r.doc_id], r.text.split("\n")) or left[r.doc_id] == [""] for r in before)
    # what goes is like a line that stays; a chain of near copies may end further from its first one
    changed = [x for x in gone if x not in kept]
    like = sum(any(similar(x, y) for y in kept if abs(len(x) - len(y)) <= 0.25 * len(x) and len(set(x.split()) & set(y.split())) * 3 > len(set(x.split()))) for x in changed[:60])
    assert like >= 0.9 * len(changed[:60])
    before, after = seen[2]
    fps = {r.doc_id: fingerprint(r.text) for r in before}
    groups = components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    assert {r.doc_id for r in after} == set(groups.values())
    before, after = seen[3]
    texts = {r.doc_id: r for r in before}
    assert all(texts[r.doc_id] == r for r in after)
    before, after = seen[4]
    once = {r.doc_id: r.text for r in before}
    times = {i: sum(r.doc_id == i for r in before) for i in once}
    assert sum(r.length for r in after) == sum(times[i] * next(r.doc_tokens for r in after if r.doc_id == i) for i in once)
    singles = {i: t for i, t in once.items() if times[i] == 1}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc = [r for r in after if r.doc_id in singles]
    for i in singles:
        assert sum(r.length for r in by_doc if r.doc_id == i) == len(tok.encode(singles[i], add_special_tokens=False).ids) + 1


def test_odd_documents_pass_through(spark):
    docs = odd_docs(spark).selectExpr("doc_id", "text", "lang", "source", "size as n_chars")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() >= 0
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
