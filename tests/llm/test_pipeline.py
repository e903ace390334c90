"""Every stage of the pipeline against a brute-force version."""
import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from covtab.llm import langid, secrets
from tests.llm.conftest import EDGE_TEXTS
from tests.llm.test_neardup import brute_force
from tests.llm.test_quality import counts, kept
from covtab.llm.quality import RULES

STAGES = dict(corpus_pipeline.STAGES)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def source(small_docs, docs_of):
    edge = docs_of([(10_000 + i, t) for i, t in enumerate(EDGE_TEXTS)])
    return small_docs.unionByName(edge.select(small_docs.columns))


def test_stages_one_by_one(spark, source):
    sf = "/root/testdata/sf0.001"
    columns = source.columns

    out = STAGES["language"](spark, source, sf)
    assert out.columns == columns
    want = {i for i, r in by_id(source).items() if any(c.isalpha() for c in r.text or "")}
    docs = by_id(out)
    assert docs.keys() == want
    noise = spark.createDataFrame([(20_000, "съешь ещё этих мягких булок да выпей чаю", None, None, None)], source.schema)
    assert by_id(STAGES["language"](spark, source.unionByName(noise), sf)).keys() == want
    unlabelled = source.withColumn("lang", F.lit(None).cast("string"))
    assert by_id(STAGES["language"](spark, unlabelled, sf)).keys() == want

    source = spark.createDataFrame(list(docs.values()), source.schema)
    out = STAGES["quality"](spark, source, sf)
    assert out.columns == columns
    assert by_id(out) == {i: r for i, r in docs.items() if kept(counts(r.text), RULES)[1]}

    source = spark.createDataFrame(out.collect(), source.schema)
    docs = by_id(source)
    out = STAGES["near_duplicates"](spark, source, sf)
    groups = brute_force({i: r.text for i, r in docs.items()}, 5)
    assert by_id(out) == {i: r for i, r in docs.items() if groups[i][1] == i}

    source = spark.createDataFrame(out.collect(), source.schema)
    docs = by_id(source)
    out = STAGES["secrets"](spark, source, sf)
    table = secrets.train(source)
    for i, r in by_id(out).items():
        text = docs[i].text
        assert r.text == secrets.redact_text(text, table)
        assert r.n_chars == (docs[i].n_chars if r.text == text else len(r.text))
        assert not secrets.base_spans(r.text)
        if not secrets.base_spans(text) and not secrets.markov_spans(text, [], table):
            assert r == docs[i]
    assert by_id(out).keys() == docs.keys()

    pieces = STAGES["packing"](spark, out, sf).collect()
    assert {p.doc_id for p in pieces} == docs.keys()


def test_run_packs_every_kept_document(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    total = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert pieces and all(total[p.doc_id] == p.doc_tokens for p in pieces)


def test_stages_of_an_empty_table(spark, small_docs):
    docs = small_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
    assert langid.train(docs) == {}
