import pytest
from pyspark.sql import functions as F

from lodestrata.operators import embedding, index

EMBED = embedding.hashing_embedder(32)


def chunk_df(spark, rows):
    df = spark.createDataFrame(rows, "path string, chunk_pos int, chunk_content string")
    return df.select("*", F.lit("S").alias("chunk_section"), F.lit("final").alias("chunk_type"), F.md5(F.col("chunk_content").cast("binary")).alias("chunk_id"))


def content(df):
    return sorted((r["chunk_content"], r["path"], r["chunk_pos"], tuple(r["embedding"])) for r in df.collect())


OLD = [("p1", 0, "alpha"), ("p1", 1, "beta"), ("p2", 0, "gamma"), ("p0", 3, "alpha"), ("p0", 1, "alpha")]
NEW = [("p1", 1, "beta"), ("p3", 0, "gamma"), ("p4", 0, "delta"), ("p4", 1, "delta")]


def test_one_row_per_id_lowest_place_wins(spark):
    rows = {r["chunk_content"]: (r["path"], r["chunk_pos"]) for r in index.index_rows(chunk_df(spark, OLD)).collect()}
    assert rows == {"alpha": ("p0", 1), "beta": ("p1", 1), "gamma": ("p2", 0)}


def test_hot_copy_is_reduced_before_the_shuffle(spark):
    plan = index.index_rows(chunk_df(spark, OLD))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1 and "partial_min" in plan


def test_changes(spark):
    changes = index.chunk_changes(index.index_rows(chunk_df(spark, OLD)), index.index_rows(chunk_df(spark, NEW)))
    names = {r["chunk_content"]: r["change"] for r in changes.collect()}
    assert names == {"delta": "insert", "gamma": "update", None: "delete"}


def test_sync_equals_rebuild_and_repeats_safely(spark, tmp_path):
    root, fresh = str(tmp_path / "a"), str(tmp_path / "b")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    index.build_index(chunk_df(spark, NEW), EMBED, fresh)
    want = content(index.current_index(spark, fresh))
    assert content(index.sync_index(spark, root, chunk_df(spark, NEW), EMBED, 1)) == want
    assert content(index.sync_index(spark, root, chunk_df(spark, NEW), EMBED, 1)) == want  # the same batch again
    assert content(index.sync_index(spark, root, chunk_df(spark, OLD), EMBED, 2)) == content(
        index.embed_index(index.index_rows(chunk_df(spark, OLD)), EMBED)
    )
    # only the changes of a batch are written
    assert index.read_log(spark, root).filter("batch = 1").count() == 3


def test_compaction_keeps_the_live_rows(spark, tmp_path):
    root, target = str(tmp_path / "a"), str(tmp_path / "b")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    live = content(index.sync_index(spark, root, chunk_df(spark, NEW), EMBED, 1))
    assert content(index.compact_index(spark, root, target)) == live
    assert index.last_batch(spark, target) == 0


def test_append_repeats_safely(spark, tmp_path):
    root = str(tmp_path / "a")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    for _ in range(2):  # the second time is the retry of a failed micro-batch
        index.append_index(spark, root, chunk_df(spark, NEW), EMBED, 1)
        assert index.index_row_count(spark, root) == 4
    assert [r["chunk_content"] for r in index.read_log(spark, root).filter("batch = 1").collect()] == ["delta"]


def test_refresh_build_force_and_count(spark, tmp_path):
    root = str(tmp_path / "r")
    assert index.index_row_count(spark, root) is None
    assert index.refresh_index(spark, root, chunk_df(spark, OLD), EMBED).count() == 3
    assert index.refresh_index(spark, root, chunk_df(spark, NEW), EMBED).count() == 3
    assert index.last_batch(spark, root) == 1
    assert index.refresh_index(spark, root, chunk_df(spark, NEW), EMBED, force=True).count() == 3
    assert index.last_batch(spark, root) == 2
    assert index.index_row_count(spark, root) == 3
    with pytest.raises(Exception):
        index.build_index(chunk_df(spark, NEW), EMBED, root)


def test_failed_rebuild_keeps_the_old_index(spark, tmp_path):
    root = str(tmp_path / "f")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    old = content(index.current_index(spark, root))

    def broken(text):
        return F.raise_error(F.lit("no model")).cast("array<float>")

    with pytest.raises(Exception, match="no model"):
        index.rebuild_index(chunk_df(spark, NEW), broken, root)
    assert content(index.current_index(spark, root)) == old
    index.rebuild_index(chunk_df(spark, NEW), EMBED, root)
    assert content(index.current_index(spark, root)) == content(index.embed_index(index.index_rows(chunk_df(spark, NEW)), EMBED))


def test_writers_never_share_a_batch(spark, tmp_path):
    root = str(tmp_path / "w")
    assert index.claim_batch(spark, root, "stream", "0") == 0
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    live = index.refresh_index(spark, root, chunk_df(spark, NEW), EMBED)
    assert index.claim_batch(spark, root, "stream", "1") == 2 == index.claim_batch(spark, root, "stream", "1")
    index.append_index(spark, root, chunk_df(spark, [("a", 0, "delta"), ("z", 0, "beta"), ("n", 0, "new")]), EMBED, 2)
    rows = {r["chunk_content"]: r["path"] for r in index.current_index(spark, root).collect()}
    assert rows == {"beta": "p1", "gamma": "p3", "delta": "a", "new": "n"}  # lower places win, as in a build


def test_sync_compares_without_texts(spark, tmp_path):
    root = str(tmp_path / "t")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    chunk_df(spark, NEW).write.parquet(str(tmp_path / "chunks"))
    new = index.places(spark.read.parquet(str(tmp_path / "chunks"))).withColumn("chunk_content", F.lit(None).cast("string"))
    plan = index.chunk_changes(index.current_index(spark, root), new)._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("chunk_content" not in line.split("ReadSchema")[1] for line in read)


def test_stats(spark, tmp_path):
    index.build_index(chunk_df(spark, OLD), EMBED, str(tmp_path / "s"))
    row = index.index_stats(index.current_index(spark, str(tmp_path / "s"))).first()
    assert tuple(row) == (3, 3, 32, 32)


def test_reading_does_not_shuffle_the_bulk(spark, tmp_path):
    root = str(tmp_path / "p")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    index.append_index(spark, root, chunk_df(spark, NEW), EMBED, 1)
    grown = index.current_index(spark, root)
    assert grown.count() == 4 and "hashpartitioning" not in executed(grown.select("embedding"))
    index.sync_index(spark, root, chunk_df(spark, NEW), EMBED, 2)
    plan = executed(index.current_index(spark, root).select("embedding"))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_deleted_text_can_come_back(spark, tmp_path):
    root = str(tmp_path / "d")
    index.build_index(chunk_df(spark, OLD), EMBED, root)
    steps = [NEW, OLD, [], OLD[:1], [("p9", 9, "alpha")], NEW]
    for batch, rows in enumerate(steps, 1):
        chunks = chunk_df(spark, rows) if rows else chunk_df(spark, OLD).limit(0)
        live = index.sync_index(spark, root, chunks, EMBED, batch)
        assert content(live) == content(index.embed_index(index.index_rows(chunks), EMBED))
        assert content(index.current_index(spark, root, before=1)) == content(index.embed_index(index.index_rows(chunk_df(spark, OLD)), EMBED))


def test_index_streams_from_gold_without_landing_it_again(spark, tmp_path):
    """The stream takes the gold table's own files where there are enough of them, each copy of a text at its lowest place."""
    import glob

    from lodestrata.plans import catalogue

    texts = [f"Alpha {i % 40} beta gamma.\n\nDelta {i % 7} epsilon." for i in range(200)]
    docs = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(40).write.parquet(f"{tmp_path}/documents.parquet")  # four tasks, so four files of every table
    folder = spark.conf.get("spark.checkpoint.dir") + "/lodestrata/medallion-*"
    known = set(glob.glob(folder))
    got = sorted(map(tuple, catalogue.stream_index(spark, str(tmp_path)).collect()))
    (own,) = set(glob.glob(folder)) - known
    assert not glob.glob(f"{own}/landed")
    assert len(glob.glob(f"{own}/index/batch=*")) > 1
    assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{own}/gold/*.parquet"))
    assert got == sorted(map(tuple, catalogue.index_snapshot(spark, str(tmp_path)).collect()))
