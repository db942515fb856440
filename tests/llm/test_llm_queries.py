import hashlib

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from lodestrata.llm import jaccard, pii, quality_rules
from lodestrata.llm.queries import QUERIES
from lodestrata.llm.sql import ORACLES
from tests.llm import cases
from tests.test_queries import TABLES, rows

COLUMNS = {
    "op1": "doc_id size source_size target taken",
    "op2": "doc_id n_shingles component_id",
    "op3": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op4": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "doc_id size text_crc32 law shard slot grown_shard",
    "op7": "doc_id family",
    "op8": "doc_id held_out score predicted",
    "op9": "query_id rank vec_id score",
    "op11": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op10": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_point.queries()
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(entry_point.oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    got = QUERIES[name](spark, sf).toArrow().to_pandas()
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(got.columns)
    if name in ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = con.execute(ORACLES[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def staged(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialise(stage(spark, out[-1], sf), name))
    return out


def test_stages_take_effect(spark, sf):
    docs, good, single, clean, mixed, tokens = staged(spark, sf)
    for table in (good, single, clean, mixed):
        assert table.columns == docs.columns
    judged = quality_rules.judged_documents(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert {r[0] for r in good.select("doc_id").collect()} == {r["doc_id"] for r in judged.where("kept").collect()}
    like = jaccard.Similarity(5, 80)
    groups = jaccard.jaccard_components(good, like).collect()
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted({r["component_id"] for r in groups})
    assert all(not pii.base_spans(r["text"]) for r in clean.collect())
    assert mixed.select("doc_id").distinct().count() <= clean.count() < mixed.count()
    assert tokens.count() == mixed.count()
    digest = {hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed.collect()}
    assert {r["decoded_sha256"] for r in tokens.collect()} == digest


def test_stages_on_awkward_and_empty_tables(spark, sf):
    for docs in (cases.documents(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, sf), name)
    assert docs.count() == 0
