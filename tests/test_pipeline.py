import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lodestrata.functions.chunking import ChunkOptions
from lodestrata.functions.elements import TYPED_ELEMENT
from lodestrata.operators import embedding, layout, quality
from lodestrata.sources import documents, files, naming, tables, workspace
from lodestrata.streaming import index_sync, medallion


def write_files(folder, names):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in names.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)


FIRST = {"a.txt": "Title A\n" + "word " * 40, "deep/b.txt": "| x | y |\nTail " + "z" * 90, "skip.md": "no"}
SECOND = {"c.txt": "Title A\n" + "word " * 40, "d.txt": "Title D\nshort"}


def test_stream_equals_batch_and_reruns_add_nothing(spark, tmp_path):
    drop, options = tmp_path / "drop", ChunkOptions(20, 5)
    flow = medallion.Medallion(str(tmp_path / "flow"), documents.text_parser, options)

    def run():
        flow.run(files.stream_raw_files(spark, str(drop), "*.txt", max_files=1))
        return flow.chunks(spark)

    write_files(drop, FIRST)
    first = run().count()
    write_files(drop, SECOND)
    second = run()
    assert second.count() > first
    columns = ["path", "file_name", "chunk_pos", "chunk_content", "chunk_section", "chunk_type", "chunk_id"]
    batch = medallion.chunk_table(
        medallion.parsed_documents(files.raw_files(spark, str(drop), "*.txt"), documents.text_parser), options
    )
    got, want = sorted(map(tuple, second.select(columns).collect())), sorted(map(tuple, batch.select(columns).collect()))
    assert got == want and {r[1] for r in got} == {"a.txt", "b.txt", "c.txt", "d.txt"}
    stamps = second.groupBy("path").agg(F.count_distinct("processed_at").alias("n")).filter("n > 1").count()
    assert stamps == 0
    assert run().count() == second.count()

    names = {t: f"{t}_docs" for t in ("bronze", "silver", "gold")}
    flow.publish(spark, names)
    flow.publish(spark, names)
    assert spark.table("gold_docs").count() == second.count()
    assert spark.table("silver_docs").selectExpr("to_json(elements)").count() == 4
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES silver_docs").collect()}
    assert shown["quality"] == "silver"
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")

    chunks = index_sync.stream_chunk_rows(spark, flow.folder("gold"), max_files=1)
    live = index_sync.sync_stream(chunks, flow.folder("index"), embedding.hashing_embedder(8), flow.folder("ck"))
    assert live.count() == second.select("chunk_id").distinct().count() < second.count()
    again = index_sync.sync_stream(chunks, flow.folder("index"), embedding.hashing_embedder(8), flow.folder("ck"))
    assert again.count() == live.count()


def test_index_stream_survives_a_failure_between_write_and_commit(spark, tmp_path, monkeypatch):
    rows = spark.range(12).select(
        F.concat(F.lit("p"), "id").alias("path"), F.lit("f").alias("file_name"), F.current_timestamp().alias("processed_at"),
        F.lit(0).alias("chunk_pos"), F.concat(F.lit("text "), F.col("id") % 5).alias("chunk_content"), F.lit("S").alias("chunk_section"),
        F.lit("final").alias("chunk_type"), F.md5(F.concat(F.lit("text "), F.col("id") % 5).cast("binary")).alias("chunk_id"),
    )
    gold, root, checkpoint = (str(tmp_path / x) for x in ("gold", "index", "ck"))
    rows.repartition(4).write.parquet(gold)

    def run():
        chunks = index_sync.stream_chunk_rows(spark, gold, max_files=1)
        return index_sync.sync_stream(chunks, root, embedding.hashing_embedder(8), checkpoint)

    real, calls = index_sync.append_index, []

    def failing(*args):
        real(*args)
        calls.append(args[-1])
        if len(calls) == 2:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(index_sync, "append_index", failing)
    with pytest.raises(Exception, match="executor lost"):
        run()
    live = run()
    assert calls == [1, 2, 2, 3]  # the failed batch ran again
    assert sorted(r["chunk_content"] for r in live.collect()) == [f"text {i}" for i in range(5)]


def test_pipeline_counts_violations(spark, tmp_path):
    texts = {
        "good.json": '{"document":{"elements":[{"content":"abc"}]}}',
        "null.json": '{"document":{"elements":[{"content":null}]}}',
        "none.json": "{}",
        "bad.json": "{oops",
    }
    write_files(tmp_path / "in", texts)
    flow = medallion.Medallion(str(tmp_path / "flow"), documents.json_parser, ChunkOptions(10, 0), strict=False)
    seen = flow.run(files.stream_raw_files(spark, str(tmp_path / "in"), "*.json", max_files=2))
    assert seen["parsed_docs"] == {"valid_content": 2, "valid_path": 0, "rows": 4}
    assert seen["documents"] == {"has_chunks": 3, "rows": 4}
    assert seen["chunked_docs"] == {"valid_chunk": 0, "valid_chunk_id": 0, "rows": 1}
    strict_rows = medallion.Medallion(str(tmp_path / "drop"), documents.json_parser, ChunkOptions(10, 0), "drop", strict=False)
    strict_rows.run(files.stream_raw_files(spark, str(tmp_path / "in"), "*.json"))
    assert spark.read.schema(medallion.SILVER_SCHEMA).parquet(strict_rows.folder("silver")).count() == 2
    failing = medallion.Medallion(str(tmp_path / "fail"), documents.json_parser, ChunkOptions(10, 0), "fail", strict=False)
    with pytest.raises(Exception, match="valid_content"):
        failing.run(files.stream_raw_files(spark, str(tmp_path / "in"), "*.json"))


def test_raw_stream_columns(spark, tmp_path):
    write_files(tmp_path / "in", FIRST)
    assert files.stream_raw_files(spark, str(tmp_path / "in")).columns == ["path", "modificationTime", "length", "content", "processing_timestamp"]


def test_strict_and_lenient_parsing(spark):
    raw = spark.createDataFrame([("p/x.txt", bytearray(b"a\nb"))], "path string, content binary")

    def broken(df):
        return df.withColumn("elements", F.array().cast(f"array<{TYPED_ELEMENT}>"))

    row = medallion.parsed_documents(raw, broken).selectExpr("to_json(elements) AS e", "is_variant_null(elements) AS n", "document_name").first()
    assert (row["e"], row["n"], row["document_name"]) == ("[]", False, "x.txt")


def test_json_parser_strict_and_lenient(spark):
    good, bad = b'{"document":{"elements":[{"type":"title","content":"A"}]},"error_status":"late"}', b"{oops"
    raw = spark.createDataFrame([("g", bytearray(good)), ("b", bytearray(bad))], "path string, content binary")
    lenient = medallion.parsed_documents(raw, documents.json_parser, strict=False)
    rows = {r["path"]: (r["e"], r["s"]) for r in lenient.selectExpr("path", "to_json(elements) AS e", "to_json(error_status) AS s").collect()}
    assert rows == {"g": ('[{"content":"A","type":"title"}]', '"late"'), "b": (None, None)}
    with pytest.raises(Exception, match="MALFORMED"):
        medallion.parsed_documents(raw, documents.json_parser).collect()
    chunks = medallion.chunk_table(lenient, ChunkOptions(10, 0)).collect()  # the bad document has no chunk
    assert [(c["path"], c["chunk_content"], c["chunk_section"]) for c in chunks] == [("g", "[TITLE] A", "A")]


def test_batch_parser_with_options(spark):
    raw = spark.createDataFrame([("p", bytearray(b"one,two")), ("q", None)], "path string, content binary")

    def parse(content, options):
        return [{"type": options["as"], "content": x} for x in content.decode().split(",")]

    parser = documents.batch_parser(parse, {"as": "title"})
    rows = {r["path"]: r["parsed"] for r in documents.parse_documents(raw, parser).collect()}
    assert json.loads(rows["p"])["document"]["elements"] == [{"type": "title", "content": "one"}, {"type": "title", "content": "two"}]
    assert json.loads(rows["q"])["error_status"] == "no elements"


def test_html_parser(spark):
    html = (
        "<html><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li>n</li></ul></nav>"
        "<!-- <p>gone</p> --><H1 class='x'>Top &amp; more</H1><p><b>open<br>next<p>Second &lt;tag&gt;</p><h3>Sub</h3>"
        "<table><tr><td>1</td><td>2</td></tr></table><figure>cap</figure><p> </p><footer>end</footer></body></html>"
    )
    df = spark.createDataFrame([(html,)], "h string").select(documents.html_elements(F.col("h")).alias("e"))
    assert [(e["type"], e["content"]) for e in df.first()["e"]] == [
        ("title", "Top & more"), ("text", "open next"), ("text", "Second <tag>"), ("section_header", "Sub"), ("table", "1 2"), ("figure", "cap"),
    ]


RULES = [quality.VALID_PATH, quality.Expectation("positive", "n > 0")]


def test_expectations(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), ("c", -1)], "path string, n int")
    seen = Observation("seen")
    assert quality.expect(df, RULES, "warn", seen).count() == 4
    assert seen.get == {"valid_path": 1, "positive": 2, "rows": 4}
    assert quality.expect(df, RULES, "drop", Observation("d")).count() == 1
    with pytest.raises(Exception, match="positive"):
        quality.expect(df.filter("path IS NOT NULL"), RULES, "fail", Observation("f")).collect()
    assert quality.expect(df.limit(1), RULES, "fail", Observation("g")).count() == 1
    with pytest.raises(ValueError):
        quality.expect(df, RULES, "maybe")
    report = {tuple(r) for r in quality.expectation_report(df, RULES).collect()}
    assert report == {("valid_path", 3, 1), ("positive", 2, 2)}


def test_json_null_is_not_a_violation(spark):
    df = spark.sql("""SELECT parse_json('{"document":{"elements":null}}') AS doc UNION ALL SELECT parse_json('{}')""")
    df = df.selectExpr("doc:document:elements AS elements")
    assert [tuple(r) for r in quality.expectation_report(df, [quality.VALID_CONTENT]).collect()] == [("valid_content", 1, 1)]


def test_layout_ranges_and_compaction(spark, tmp_path):
    hot = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.md5(F.col("id").cast("string").cast("binary"))).alias("chunk_id"),
        F.concat(F.lit("p"), F.col("id") % 50).alias("path"),
        F.col("id").cast("int").alias("chunk_pos"),
    )
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    hot.repartition(20).write.parquet(source)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files_ = layout.layout_stats(layout.compact(spark, source, target))
        stats = files_.orderBy("min_key", "max_key").collect()
        assert tuple(layout.layout_report(files_).first()) == (4000, 0)
        assert layout.layout_report(layout.layout_stats(spark.read.parquet(source))).first()["overlaps"] > 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["n_rows"] for r in stats) == 4000 and 2 <= len(stats) <= 8
    assert all(a["max_key"] <= b["min_key"] for a, b in zip(stats, stats[1:]))
    assert max(r["n_rows"] for r in stats) < 2000  # the hot key is spread


def test_names(spark):
    made = naming.OutputTables.of(catalog="my-cat", schema="s", base="b", version="v2")
    assert made == naming.OutputTables("`my-cat`.`s`.`b_docs__v2`", "`my-cat`.`s`.`b_docs_chunked__v2`", "my-cat.s.b_docs_chunked_index__v2")
    assert naming.name_part(made.docs, 0) == "my-cat" and naming.name_part(made.docs, 1) == "s"
    assert naming.OutputTables.of("a.b.c", "a.b.d", "a.b.e").index == "a.b.e"
    for bad in ({}, {"docs": "x"}, {"docs": "a", "chunked": "b", "index": "c", "base": "d"}, {"catalog": "REPLACE_ME", "schema": "s", "base": "b"}):
        with pytest.raises(ValueError):
            naming.OutputTables.of(**bad)
    ok = naming.OutputTables.of(catalog="spark_catalog", schema="default", base="b")
    assert ok.check(spark)[0]
    assert not naming.OutputTables.of(catalog="nowhere", schema="default", base="b").check(spark)[0]
    assert "schema" in naming.OutputTables.of(catalog="spark_catalog", schema="missing", base="b").check(spark)[1]


def test_settings(spark):
    assert naming.chunk_options(spark) == ChunkOptions(1850, 250)
    spark.conf.set("bundle.max_chunk_size", "4000")
    spark.conf.set("bundle.min_chunk_size", "400")
    try:
        assert naming.chunk_options(spark) == ChunkOptions()
    finally:
        spark.conf.unset("bundle.max_chunk_size")
        spark.conf.unset("bundle.min_chunk_size")


def test_managed_table_properties(spark):
    tables.save_table(spark.range(3), "gold_rows", "chunk rows", {"quality": "gold"})
    tables.save_table(spark.range(2), "gold_rows", "ignored")
    assert spark.table("gold_rows").count() == 5
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES gold_rows").collect()}
    assert properties["quality"] == "gold"
    assert spark.catalog.getTable("gold_rows").description == "chunk rows"
    spark.sql("DROP TABLE gold_rows")


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = workspace.work_dir(spark, "x"), workspace.work_dir(spark, "x")
    assert first != second and (base is None or first.startswith(base))
    assert workspace.materialise(spark.range(5), "m").count() == 5


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.work_dir(Session(), "x")
