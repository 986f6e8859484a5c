"""The registered queries and the pipeline."""

import os

import pytest
from llm_tables import clashing, documents  # noqa: F401

import corpus_pipeline
from checks.compare import difference, oracle_connection
from headway.llm.bpe import word_bpe
from headway.llm.language import Judge, learn
from headway.llm.mixing import mixed
from headway.llm.oracles import ORACLES
from headway.llm.queries import llm_queries

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def test_all_are_registered():
    names = llm_queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(llm_queries()[name](spark, SMALL), oracle_connection(SMALL), ORACLES[name]) == ""


def test_run_equals_stage_by_stage(spark):
    from test_near_dup import brute

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    judged = Judge(learn(docs)).texts([r.text for r in rows.values()])
    left = {d for d, (lang, score) in zip(rows, judged, strict=True) if lang != "und" and score >= corpus_pipeline.LEAST_SCORE}
    assert len(left) >= 0.99 * len(rows)
    groups = brute([(d, rows[d].text) for d in left], 5, 80)
    left = {d for d in left if groups[d][2]}
    drawn = mixed(spark.createDataFrame([rows[d] for d in left], docs.schema)).where("sampled").collect()
    assert set(got) == {r.doc_id for r in drawn}
    bpe = word_bpe(corpus_pipeline.TOKENIZER)
    for d, r in got.items():
        assert bpe.encode(rows[d].text) == b"".join(x.to_bytes(4, "little") for x in r.token_ids)


def test_stages_keep_columns_and_take_odd_rows(spark, documents, clashing):
    rows = [(1, None), (2, ""), (3, "the " * 20, "en", "a"), (3, "the " * 20, "en", "a"), (None, "le la " * 9, "fr", None), (5, "the of and " * 9000, "en", "b")]
    for table in (clashing(documents(rows)), documents([])):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == table.columns
        docs.collect()
    last = corpus_pipeline.STAGES[-1][1](spark, documents(rows), SMALL)
    assert last.count() == len(rows)
