import pytest
from pyspark.sql import functions as F

from lodestrata.operators import answers, dialog, embedding, evaluation, index
from lodestrata.plans import jobs
from lodestrata.sources import documents, naming, tables

EMBED = embedding.hashing_embedder(64)
JUDGE = evaluation.overlap_judge(0.3)
SETTINGS = {"bundle.max_chunk_size": "120", "bundle.min_chunk_size": "40"}


@pytest.fixture()
def settings(spark):
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k in SETTINGS:
        spark.conf.unset(k)


def test_the_four_jobs(spark, sf, tmp_path, settings):
    docs = tables.load(spark, sf, "documents")
    inbox, root = tmp_path / "inbox", str(tmp_path / "docs")
    inbox.mkdir()
    for r in docs.select("doc_id", "text").collect():
        (inbox / f"{r['doc_id']}.txt").write_text(r["text"])
    seen = jobs.document_job(spark, str(inbox), root, documents.text_parser, "*.txt", max_files=100)
    assert seen["documents"] == {"has_chunks": 0, "rows": docs.count()}
    gold = naming.SETTINGS["bundle.chunked_table_name"]

    names = naming.OutputTables.of(f"spark_catalog.default.{gold}", f"spark_catalog.default.{gold}", "spark_catalog.default.i")
    store = str(tmp_path / "index")
    size = jobs.index_job(spark, names, store, EMBED)
    assert size == spark.table(gold).select("chunk_id").distinct().count()
    assert jobs.index_job(spark, names, store, EMBED) == size  # a sync without changes
    assert index.read_log(spark, store).filter("batch = 1").count() == 0
    missing = naming.OutputTables.of("nowhere.default.a", "nowhere.default.b", "nowhere.default.c")
    with pytest.raises(ValueError, match="nowhere"):
        jobs.index_job(spark, missing, store, EMBED)

    live = index.current_index(spark, store)
    examples = evaluation.qa_examples(dialog.history_pairs(tables.load(spark, sf, "conversations")))
    programs = {"small": answers.leading_sentence, "large": answers.all_passages}
    registry, metrics = str(tmp_path / "registry"), str(tmp_path / "metrics")
    first = jobs.evaluation_job(examples, live, EMBED, programs, JUDGE, "m", "g0", registry, str(tmp_path / "metrics0"))
    assert first.count() == 4  # the registry started empty
    assert [tuple(r) for r in tables.read_state(spark, registry).collect()] == [("m", "challenger", 1)]
    tables.write_state(
        spark.createDataFrame([("m", "champion", 1), ("m", "challenger", 1)], "model string, alias string, version int"), registry
    )
    board = jobs.evaluation_job(examples, live, EMBED, programs, JUDGE, "m", "g1", registry, metrics, rank_by=jobs.F1_METRIC)
    best = board.filter((F.col("rank") == 1) & (F.col("metric_name") == jobs.F1_METRIC)).first()
    assert best["program"] == "large" and best["is_winner"]
    assert board.count() == 4 and spark.read.parquet(metrics).filter("kind = 'metric'").count() == 4
    assert {r["alias"]: r["version"] for r in tables.read_state(spark, registry).collect()} == {"champion": 1, "challenger": 2}

    runs = {r["version"]: r["run_id"] for r in tables.read_state(spark, f"{registry}_versions").collect()}
    assert runs[2] == f"g1-large-{jobs.F1_METRIC}" and set(runs) == {1, 2}
    tags = {(r["version"], r["key"]): r["value"] for r in tables.read_state(spark, f"{registry}_tags").collect()}
    assert tags[2, "training_run_id"] == runs[2] and tags[2, "experiment_group"] == "g1"

    versions = {1: answers.leading_sentence, 2: answers.all_passages}
    winner = jobs.champion_job(examples, live, EMBED, versions, evaluation.overlap_judge(0.1), "m", registry)
    assert winner == "challenger"
    assert {r["alias"]: r["version"] for r in tables.read_state(spark, registry).collect()} == {"champion": 2, "challenger": 2}
    # equal programs: the champion stays
    assert jobs.champion_job(examples, live, EMBED, versions, JUDGE, "m", registry) == "champion"
    for t in ("source", "parsed", "chunked"):
        spark.sql(f"DROP TABLE {naming.SETTINGS[f'bundle.{t}_table_name']}")
