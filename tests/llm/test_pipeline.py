"""The registered queries against SQL, and the pipeline against its own promises."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import frame
from tests.llm.test_decontamination import by_force
from tests.llm.test_mixing import targets
from tests.oracle import connect, sorted_rows
from tradeloom.llm import quality, sharding, simhash

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(corpus_pipeline.ORACLES))
def test_query_against_sql(spark, name):
    df = corpus_pipeline.QUERIES[name](spark, FOLDER)
    cur = connect(FOLDER).execute(corpus_pipeline.ORACLES[name])
    want = sorted_rows(cur.fetchall(), [d[0] for d in cur.description])
    assert sorted_rows(df.collect(), df.columns) == want


def test_every_operator_has_one_query():
    numbers = Counter(re.match(r"op(\d+)_", n)[1] for n in corpus_pipeline.QUERIES if n != "pipeline")
    assert numbers == {str(i): 1 for i in range(1, 14)}


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[k] = (before, docs)
        assert docs.columns[:5] == columns and (docs.columns == columns or k == 4), name
        assert docs.exceptAll(before).count() == 0 if k < 3 else True

    before, after = seen[0]
    people = spark.read.parquet(f"{FOLDER}/labels.parquet")
    keep = {r.doc_id for r in quality.judged(before, quality.train(before, people)).collect() if r.keep}
    assert {r.doc_id for r in after.collect()} == keep and len(keep) > before.count() // 2

    before, after = seen[1]
    group = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(group.values()))

    before, after = seen[2]
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in before.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {i for i, *_ in by_force(rows, items)}
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, *_ in rows if i not in dirty)

    before, after = seen[3]
    sizes, taken = Counter(), Counter()
    largest = Counter()
    for r in before.collect():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    copies = Counter()
    for r in after.collect():
        taken[r.source] += len(WORD.findall(r.text or ""))
        copies[r.doc_id] += 1
    want = targets(sizes)
    assert max(copies.values()) <= 2
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)

    before, after = seen[4]
    assert after.count() == before.count()
    plan = {r.doc_id: r.shard for r in sharding.shard_plan(before).collect()}
    assert all(plan[r.doc_id] == r.shard for r in after.collect())


def test_run_gives_what_the_stages_give(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    again = corpus_pipeline.run(spark, FOLDER)
    assert out.exceptAll(again).count() == 0 == again.exceptAll(out).count()
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard"}


def test_empty_documents(spark, tmp_path):
    docs = frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []
