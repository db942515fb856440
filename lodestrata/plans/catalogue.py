"""The registered queries. Each takes (spark, sf_dir), reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import chunking, elements, sizes, text
from lodestrata.operators import (
    answers,
    cells,
    dialog,
    embedding,
    evaluation,
    index,
    layout,
    quality,
    search,
    selection,
)
from lodestrata.operators.ordering import best_per_group
from lodestrata.plans import jobs
from lodestrata.sources import documents as parsers
from lodestrata.sources import files
from lodestrata.sources.tables import load, stream
from lodestrata.sources.workspace import materialise, work_dir
from lodestrata.streaming import index_sync as index_stream
from lodestrata.streaming import history, medallion, versions

OPTIONS = chunking.ChunkOptions(max_size=120, min_size=40)
WIDER = chunking.ChunkOptions(max_size=160, min_size=40)
TOP_K = 5
TOOL_K = 3
OVERSAMPLE = 4
VISITED_AREAS, VISITED_CELLS = 8, 28  # the vectors hardly cluster
HISTORY_PAIRS = 2
INDEX_BATCHES = 4  # micro-batches that bring the gold table into the index
PAGES_PER_FILE = 500  # keeps the content of one file small
JUDGE_SHARE = 0.3
JUDGE = evaluation.overlap_judge(JUDGE_SHARE)
PROGRAMS = {
    "leading_sentence": answers.leading_sentence,
    "top_passage": answers.top_passage,
    "all_passages": answers.all_passages,
}


# --- shared inputs -------------------------------------------------------------------------------


def _document_path() -> Column:
    return F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id and typed elements of the documents."""
    return load(spark, sf, "documents").select("doc_id", parsers.text_elements(F.col("text")).alias("elements"))


def _rendered(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, path and rendered elements of the documents."""
    return load(spark, sf, "documents").select(
        "doc_id",
        _document_path().alias("path"),
        elements.render_typed(parsers.text_elements(F.col("text"))).alias("elements"),
    )


def _element_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rendered(spark, sf).select("doc_id", F.posexplode_outer("elements").alias("pos", "e")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "e.kind", "e.text"
    )


def _chunk_rows(spark: SparkSession, sf: str, options: chunking.ChunkOptions = OPTIONS) -> DataFrame:
    rows = chunking.with_chunks(_rendered(spark, sf), "elements", options).drop("elements")
    return chunking.explode_chunks(rows)


def _embedder() -> embedding.Embedder:
    return embedding.hashing_embedder()


def _index(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "index")
    index.build_index(_chunk_rows(spark, sf), _embedder(), root)
    return index.current_index(spark, root)


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    return dialog.current_question(load(spark, sf, "conversations"))


def _examples(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.qa_examples(dialog.history_pairs(load(spark, sf, "conversations")))


def _program_runs(spark: SparkSession, sf: str, examples: DataFrame) -> DataFrame:
    return jobs.program_runs(examples, _index(spark, sf), _embedder(), PROGRAMS, TOP_K, min_score=0.0)


def _scored_runs(spark: SparkSession, sf: str, examples: DataFrame) -> DataFrame:
    return jobs.score_runs(_program_runs(spark, sf, examples), JUDGE)


def _label_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Mean label quality per language and document source, as runs to compare."""
    scored = load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")
    means = evaluation.mean_scores(scored.withColumnRenamed("source", "program"), ["lang", "program"], "quality")
    return means.withColumn("position", F.regexp_extract("program", "[0-9]+$", 0).cast("bigint")).withColumn(
        "run_id", F.concat("lang", F.lit("-"), "program")
    ).withColumn("metric_name", F.concat(F.lit("quality_"), "program"))


# --- elements and chunks -------------------------------------------------------------------------


def text_elements(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf).select("doc_id", F.posexplode_outer("elements").alias("pos", "e")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "e.type", "e.content"
    )


def html_elements(spark: SparkSession, sf: str) -> DataFrame:
    pages = load(spark, sf, "pages").select("page_id", parsers.html_elements(F.col("html")).alias("elements"))
    rows = pages.select("page_id", F.posexplode_outer("elements").alias("pos", "e")).filter("pos IS NOT NULL")
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "e.type", "e.content")


def normalize_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Messages as JSON in the three container shapes, by role, and back to elements."""
    typed = F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit("text").alias("type"), t.alias("content")))
    shaped = (
        F.when(F.col("role") == "system", F.to_json(F.struct(F.lit("text").alias("type"), F.col("text").alias("content"))))
        .when(F.col("role") == "user", F.to_json(typed))
        .otherwise(F.to_json(F.struct(typed.alias("elements"))))
    )
    messages = load(spark, sf, "conversations").select("conv_id", "turn", shaped.alias("payload"))
    rendered = messages.select("conv_id", "turn", elements.render_json("payload").alias("elements"))
    rows = rendered.select("conv_id", "turn", F.posexplode_outer("elements").alias("pos", "e"))
    return rows.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "e.kind", "e.text")


def element_text(spark: SparkSession, sf: str) -> DataFrame:
    return _element_rows(spark, sf)


def section_breaks(spark: SparkSession, sf: str) -> DataFrame:
    return _element_rows(spark, sf).filter(elements.is_section_break(F.col("kind"))).select("doc_id", "pos", "kind")


def element_sections(spark: SparkSession, sf: str) -> DataFrame:
    labels = _rendered(spark, sf).select("doc_id", chunking.section_labels("elements").alias("labels"))
    return labels.select("doc_id", F.posexplode_outer("labels").alias("pos", "section")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "section"
    )


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _element_rows(spark, sf).select("doc_id", "pos", sizes.chars_div_4(F.col("text")).alias("size"))


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _chunk_rows(spark, sf).select(
        "doc_id", "path", F.col("chunk_pos").cast("bigint").alias("chunk_pos"),
        "chunk_id", "chunk_content", "chunk_section", "chunk_type",
    )


def json_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The chunk function over JSON text, as SQL users call it."""
    chunking.register_chunk_function(spark, OPTIONS)
    payload = load(spark, sf, "documents").select(
        "doc_id", F.to_json(F.struct(parsers.text_elements(F.col("text")).alias("elements"))).alias("payload")
    )
    rows = chunking.explode_chunks(payload.select("doc_id", F.expr("chunk_elements(payload)").alias("chunks")))
    return rows.select("doc_id", F.col("chunk_pos").cast("bigint").alias("chunk_pos"), "chunk_id", "chunk_section", "chunk_type")


def chunk_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _chunk_rows(spark, sf).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_chunks"))


def chunk_type_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = _chunk_rows(spark, sf).select("chunk_type", F.length("chunk_content").cast("bigint").alias("n"))
    return (
        rows.rollup("chunk_type")
        .agg(
            F.count(F.lit(1)).alias("n_chunks"),
            F.min("n").alias("min_chars"),
            F.max("n").alias("max_chars"),
            F.sum("n").alias("sum_chars"),
        )
        .withColumn("chunk_type", F.coalesce("chunk_type", F.lit("(all)")))
    )


def atomic_overflow(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks over the size limit that hold a table: tables never start a chunk of their own."""
    size = sizes.chars_div_4(F.col("chunk_content"))
    holds = F.concat(F.lit("\n\n"), "chunk_content").contains("\n\n" + elements.PREFIXES["table"])
    return _chunk_rows(spark, sf).filter((size > OPTIONS.max_size) & holds).select(
        "doc_id", F.col("chunk_pos").cast("bigint").alias("chunk_pos"), "chunk_type", size.alias("size")
    )


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as parser output: one of 41 is cut JSON, one of 41 holds a null element, German ones
    come as an object, the rest as a list."""
    typed = parsers.text_elements(F.col("text"))
    payload = (
        F.when(F.col("doc_id") % 41 == 7, F.concat(F.lit("{"), F.to_json(typed)))
        .when(F.col("doc_id") % 41 == 8, F.lit('[{"type":"text","content":null}]'))
        .when(F.col("lang") == "de", F.to_json(F.struct(typed.alias("elements"))))
        .otherwise(F.to_json(typed))
    )
    return load(spark, sf, "documents").select("doc_id", "source", payload.alias("payload"))


def docs_without_chunks(spark: SparkSession, sf: str) -> DataFrame:
    made = _payloads(spark, sf).select("source", F.size(chunking.json_chunks("payload", OPTIONS)).alias("n"))
    return made.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("n") == 0).alias("n_without_chunks"),
        F.sum("n").cast("bigint").alias("n_chunks"),
    )


# --- projections and checks ----------------------------------------------------------------------


def variant_paths(spark: SparkSession, sf: str) -> DataFrame:
    parsed = load(spark, sf, "events").select("event_id", F.parse_json("props").alias("doc"))
    return parsed.select(
        "event_id",
        F.expr("doc:k::bigint").alias("k"),
        F.expr("doc:document:elements IS NULL").alias("elements_missing"),
        F.expr("to_json(doc:k)").alias("k_json"),
    )


def file_name(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "pages").select("page_id", text.file_name(F.col("url")).alias("file_name"))


def expectation_report(spark: SparkSession, sf: str) -> DataFrame:
    """The four rules, counted over damaged parser output, page names and chunk rows."""
    parsed = _payloads(spark, sf).select(F.expr("try_parse_json(payload):elements").alias("elements"))
    pages = load(spark, sf, "pages").select(F.nullif(text.file_name(F.col("url")), F.lit("")).alias("path"))
    made = _chunk_rows(spark, sf).select("chunk_content", "chunk_id")
    return (
        quality.expectation_report(parsed, [quality.VALID_CONTENT])
        .unionByName(quality.expectation_report(pages, [quality.VALID_PATH]))
        .unionByName(quality.expectation_report(made, [quality.VALID_CHUNK, quality.VALID_CHUNK_ID]))
    )


# --- index and search ----------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "embeddings").select("vec_id", "embedding")


def topk_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest other vectors of every vector."""
    vectors = _vectors(spark, sf)
    return _ranked(search.top_k(vectors, vectors, TOP_K, "vec_id", "vec_id", skip_self=True))


def _ranked(hits: DataFrame) -> DataFrame:
    return hits.select("vec_id", F.col("rank").cast("bigint").alias("rank"), "hit_vec_id", "score")


def topk_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same search by the plan for tables that are too large to broadcast."""
    vectors = _vectors(spark, sf)
    return _ranked(search.top_k(vectors, vectors, TOP_K, "vec_id", "vec_id", skip_self=True, broadcast_bytes=0))


def _kept_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest neighbours of all vectors in a kept index: pivots from a first part, the rest added later, some removed again."""
    root = work_dir(spark, "cells")
    vectors = _vectors(spark, sf).select("vec_id", F.col("vec_id").alias("item"), F.col("embedding").alias("vector"))
    cells.build_cells(vectors.where("vec_id % 4 <> 0").drop("vec_id"), root)
    cells.add_vectors(vectors.where("vec_id % 4 = 0").drop("vec_id"), root, 1)
    cells.remove_vectors(vectors.where("vec_id % 10 = 3").select("item"), root, 2)
    asked = vectors.select(F.col("vec_id").alias("query"), "vector")
    found = cells.search_cells(asked, root, TOP_K + 1, VISITED_AREAS, VISITED_CELLS)
    others = found.where("item <> query").select(F.col("query").alias("vec_id"), F.col("item").alias("hit_vec_id"), "score")
    return best_per_group(others, ["vec_id"], [F.desc("score"), F.asc("hit_vec_id")], TOP_K)


def ann_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(_kept_cells(spark, sf))


def ann_recall(spark: SparkSession, sf: str) -> DataFrame:
    """What the kept index finds of the exact hits among the vectors that it holds."""
    vectors = _vectors(spark, sf)
    exact = search.top_k(vectors, vectors.where("vec_id % 10 <> 3"), TOP_K, "vec_id", "vec_id", skip_self=True)
    return search.recall(_kept_cells(spark, sf), exact, "vec_id", "hit_vec_id")


def embed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedding.embed(index.index_rows(_chunk_rows(spark, sf)), "chunk_content", _embedder())
    filled = F.filter("embedding", lambda x: x > 0)
    weighted = F.transform("embedding", lambda x, i: x.cast("bigint") * i)
    return rows.select(
        "chunk_id",
        F.size("embedding").cast("bigint").alias("dim"),
        F.size(filled).cast("bigint").alias("n_filled"),
        F.aggregate("embedding", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")).alias("n_tokens"),
        F.aggregate(weighted, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("checksum"),
    )


def _placed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "chunk_id", "path", F.col("chunk_pos").cast("bigint").alias("chunk_pos"), "chunk_section", "chunk_type",
        F.aggregate("embedding", F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint")).alias("n_tokens"),
    )


def index_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(_index(spark, sf))


def index_stats(spark: SparkSession, sf: str) -> DataFrame:
    return index.index_stats(_index(spark, sf))


def chunk_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What changes in the keyed chunk table when all documents are cut with a wider limit."""
    old, new = index.index_rows(_chunk_rows(spark, sf)), index.index_rows(_chunk_rows(spark, sf, WIDER))
    return index.chunk_changes(old, new).select("chunk_id", "change")


def index_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Index over the old chunks, brought in step with the wider chunks."""
    root = work_dir(spark, "index")
    index.build_index(_chunk_rows(spark, sf), _embedder(), root)
    return _placed(index.sync_index(spark, root, _chunk_rows(spark, sf, WIDER), _embedder(), batch=1))


def _reranked(spark: SparkSession, sf: str, scorer: Callable[[Column, Column], Column]) -> DataFrame:
    asked = load(spark, sf, "benchmark").select("item_id", F.col("text").alias("question"))
    found = search.retrieve(asked, _index(spark, sf), _embedder(), TOOL_K * OVERSAMPLE, query_id="item_id", min_score=0.0)
    best = search.rerank(found, asked, TOOL_K, query_id="item_id", scorer=scorer)
    return best.select(
        "item_id", F.col("rank").cast("bigint").alias("rank"), F.col("first_rank").cast("bigint").alias("first_rank"),
        "chunk_id", "rerank_score", "score",
    )


def rerank_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts as queries; twelve candidates each, reranked to three by shared tokens."""
    return _reranked(spark, sf, search.token_overlap)


def rerank_late(spark: SparkSession, sf: str) -> DataFrame:
    """The same candidates, reranked by the best match of each token."""
    return _reranked(spark, sf, search.late_interaction())


def format_hits(spark: SparkSession, sf: str) -> DataFrame:
    """The search tool over each conversation's current question; one of ten is left blank."""
    blank = F.col("conv_id") % 10 == 0
    asked = _questions(spark, sf).withColumn("question", F.when(blank, " ").otherwise(F.col("question")))
    asked = materialise(asked, "asked")
    found = search.retrieve(asked, _index(spark, sf), _embedder(), TOOL_K, query_id="conv_id", min_score=0.0)
    return search.format_hits(asked, found, query_id="conv_id")


# --- streams -------------------------------------------------------------------------------------


def _pipeline(spark: SparkSession, sf: str) -> medallion.Medallion:
    """Documents as a file stream through bronze, silver and gold."""
    source = stream(spark, sf, "documents").select(
        _document_path().alias("path"),
        F.col("text").cast("binary").alias("content"),
        F.current_timestamp().alias("processing_timestamp"),
    )
    flow = medallion.Medallion(work_dir(spark, "medallion"), parsers.text_parser, OPTIONS)
    flow.run(source)
    return flow


def stream_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _pipeline(spark, sf).chunks(spark).select(
        "path", "file_name", F.col("chunk_pos").cast("bigint").alias("chunk_pos"), "chunk_id", "chunk_section", "chunk_type"
    )


def stream_index(spark: SparkSession, sf: str) -> DataFrame:
    """The gold table streamed into an index in about four micro-batches, copies of a text in any of them."""
    flow = _pipeline(spark, sf)
    gold = flow.chunks(spark)
    folder, files = flow.folder("gold"), len(gold.inputFiles())
    if files < INDEX_BATCHES:  # a file is the least that a micro-batch takes
        folder, files = flow.folder("landed"), max(INDEX_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
        gold.repartition(files, "path").write.parquet(folder)
    rows = index_stream.stream_chunk_rows(spark, folder, max_files=-(-files // INDEX_BATCHES))
    live = index_stream.sync_stream(rows, flow.folder("index"), _embedder(), flow.folder("_checkpoints/index"))
    return _placed(live)


def _revised(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Two versions of the documents: in the second some are new, some are gone, some have another line."""
    rows = load(spark, sf, "documents").select("doc_id", _document_path().alias("path"), "text")
    first = rows.where("doc_id % 11 <> 0")
    edited = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("\nRevised in this version."))).otherwise(F.col("text"))
    second = rows.where("doc_id % 7 <> 0").withColumn("text", edited)
    return [v.select("path", "text", F.md5("text").alias("fingerprint")) for v in (first, second)]


def stream_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the documents, one after another, streamed into one index by what changed between them."""
    root = work_dir(spark, "versions")
    for snapshot in _revised(spark, sf):
        versions.record_versions(snapshot, f"{root}/log")
        seen = versions.version_stream(spark, f"{root}/log", "path string, text string")
        rendered = seen.withColumn("elements", elements.render_typed(parsers.text_elements(F.coalesce("text", F.lit("")))))
        changes = versions.chunk_changes(chunking.with_chunks(rendered, "elements", OPTIONS))
        with versions.keyed_state(spark):
            medallion.run_available(changes, f"{root}/changes", f"{root}/_checkpoints/changes")
        gained = versions.occurrence_stream(spark, f"{root}/changes")
        live = versions.sync_changes(gained, f"{root}/index", _embedder(), f"{root}/_checkpoints/index")
    return _placed(live)


def ingest_files(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written to text files of bounded size, taken in by the binary-file stream, each file once;
    then every line of the landed contents."""
    root = work_dir(spark, "ingest")
    load(spark, sf, "pages").select("html").write.option("maxRecordsPerFile", PAGES_PER_FILE).text(f"{root}/inbox")
    medallion.run_available(files.stream_raw_files(spark, f"{root}/inbox", "*.txt"), f"{root}/raw", f"{root}/_checkpoint")
    landed = spark.read.schema(files.FILE_SCHEMA).parquet(f"{root}/raw")
    lines = landed.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).filter("line <> ''")
    return lines.select(F.length("line").cast("bigint").alias("n_chars"), F.md5(F.col("line").cast("binary")).alias("line_md5"))


def layout_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the clustered chunk table, and files whose key ranges overlap."""
    written, path = work_dir(spark, "chunks"), work_dir(spark, "clustered")
    _chunk_rows(spark, sf).write.parquet(written)  # range partitioning reads its input twice
    return layout.layout_report(layout.layout_stats(layout.compact(spark, written, path)))


# --- conversations and answers -------------------------------------------------------------------


def history_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return dialog.history_pairs(load(spark, sf, "conversations"))


def history_recent(spark: SparkSession, sf: str) -> DataFrame:
    return dialog.recent_history(dialog.history_pairs(load(spark, sf, "conversations")), HISTORY_PAIRS)


def history_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = dialog.nested_history(load(spark, sf, "conversations"), HISTORY_PAIRS)
    return nested.select(
        "conv_id",
        F.size("history").cast("bigint").alias("n_pairs"),
        F.array_join(
            F.transform("history", lambda p: F.concat(F.lit("Q: "), p["question"], F.lit("\nA: "), p["response"])), "\n"
        ).alias("history"),
    )


def stream_history(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations that arrive in four parts, by turn; pairs as they become known, with the history so far."""
    root = work_dir(spark, "history")
    messages = load(spark, sf, "conversations").withColumn("event_time", F.timestamp_seconds(F.col("turn") + 1_000_000_000))
    last = messages.agg(F.max("turn")).first()[0] or 0
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for part in range(4):
        arrived = messages.where(F.floor(F.col("turn") * 4 / (last + 1)) == part)
        arrived.repartition(files, "conv_id").write.mode("append").parquet(f"{root}/messages")
    seen = history.message_stream(spark, f"{root}/messages", "conv_id bigint, turn bigint, role string, text string, event_time timestamp", files)
    with versions.keyed_state(spark):
        medallion.run_available(history.stream_pairs(seen, HISTORY_PAIRS), f"{root}/pairs", f"{root}/_checkpoint")
    pairs = spark.read.schema(history.PAIR_SCHEMA).parquet(f"{root}/pairs")
    asked = F.array_join(F.transform("history", lambda p: p["question"]), "\n")
    return pairs.select("conv_id", "turn", "question", "response", asked.alias("asked"))


def history_gapped(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of conversations whose turn numbers were doubled and of which some messages are gone."""
    kept = load(spark, sf, "conversations").filter("(conv_id + turn) % 5 <> 0")
    return dialog.history_pairs(kept.withColumn("turn", 2 * F.col("turn")))


def current_question(spark: SparkSession, sf: str) -> DataFrame:
    return _questions(spark, sf)


def plain_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts as one-turn conversations: the text is the question, the history is empty."""
    one_turn = dialog.as_conversations(load(spark, sf, "benchmark"), "item_id", "text")
    pairs = dialog.nested_history(one_turn, HISTORY_PAIRS)
    return dialog.current_question(one_turn).join(pairs, "conv_id").select(
        F.col("conv_id").alias("item_id"), "question", F.size("history").cast("bigint").alias("n_pairs")
    )


def validate_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every document id as a request; most have no conversation. In one conversation of five the
    messages are blanked."""
    blank = F.col("conv_id") % 5 == 0
    messages = load(spark, sf, "conversations").withColumn("text", F.when(blank, " \t\n").otherwise(F.col("text")))
    requests = load(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"))
    return dialog.validate_requests(requests, messages)


def _conversation_hits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    asked = materialise(_questions(spark, sf), "questions")
    return asked, search.retrieve(asked, _index(spark, sf), _embedder(), TOP_K, query_id="conv_id", min_score=0.0)


def rag_context(spark: SparkSession, sf: str) -> DataFrame:
    _, hits = _conversation_hits(spark, sf)
    return answers.assemble_context(hits, "conv_id").select("conv_id", answers.context_text(F.col("passages")).alias("context"))


def _inputs(spark: SparkSession, sf: str) -> DataFrame:
    asked, hits = _conversation_hits(spark, sf)
    history = dialog.history_text(dialog.nested_history(load(spark, sf, "conversations"), HISTORY_PAIRS))
    return answers.prompt_inputs(asked, answers.assemble_context(hits, "conv_id"), history)


def rag_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return _inputs(spark, sf).select("conv_id", "question", answers.context_text(F.col("passages")).alias("context"), "history")


def rag_answers(spark: SparkSession, sf: str) -> DataFrame:
    return answers.answer(_inputs(spark, sf)).select("conv_id", "response")


def coerce_response(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw responses: an object, a JSON string or plain text, by event type."""
    body = F.concat(F.col("event_type"), F.lit(" "), F.col("user_id").cast("string"))
    raw = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct(body.alias("response"))))
        .when(F.col("event_type") == "view", F.concat(F.lit('"'), body, F.lit('"')))
        .otherwise(body)
    )
    return load(spark, sf, "events").select("event_id", answers.coerce_response(raw).alias("response"))


# --- evaluation and selection --------------------------------------------------------------------


def qa_examples(spark: SparkSession, sf: str) -> DataFrame:
    return _examples(spark, sf).select(
        "example_id", "question", "response", F.col("messages")[0]["content"].alias("first_message")
    )


def split_full(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.split_examples(_examples(spark, sf).select("example_id")).select("example_id", "position", "split")


def split_test_mode(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.split_test_mode(_examples(spark, sf).select("example_id")).select("example_id", "position", "split")


def judge_score(spark: SparkSession, sf: str) -> DataFrame:
    runs = _program_runs(spark, sf, _examples(spark, sf))
    return evaluation.judge_score(runs, JUDGE).select(
        "program", "example_id", F.col("score").cast("bigint").alias("score"), "feedback"
    )


def token_f1(spark: SparkSession, sf: str) -> DataFrame:
    runs = _program_runs(spark, sf, _examples(spark, sf))
    return evaluation.token_f1(runs, ["program", "example_id"])


def mean_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.mean_scores(_scored_runs(spark, sf, _examples(spark, sf)), ["program", "metric_name"])


def _test_means(spark: SparkSession, sf: str) -> DataFrame:
    split = evaluation.split_examples(_examples(spark, sf))
    return evaluation.mean_scores(_scored_runs(spark, sf, split.filter("split = 'test'")), ["program", "metric_name"])


def eval_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Every program on every test example, scored by every metric."""
    split = evaluation.split_examples(_examples(spark, sf))
    scored = _scored_runs(spark, sf, split.filter("split = 'test'"))
    return scored.select("program", "example_id", "metric_name", "score")


def baseline_gain(spark: SparkSession, sf: str) -> DataFrame:
    return selection.baseline_gain(
        _test_means(spark, sf), "all_passages", "leading_sentence", "top_passage", by=["metric_name"]
    )


def champion_challenger(spark: SparkSession, sf: str) -> DataFrame:
    return selection.champion_challenger(_test_means(spark, sf), "top_passage", "all_passages", by=["metric_name"])


def demo_select(spark: SparkSession, sf: str) -> DataFrame:
    train = materialise(evaluation.split_examples(_examples(spark, sf)).filter("split = 'train'"), "train")
    runs = evaluation.judge_score(_program_runs(spark, sf, train), JUDGE)
    scored = runs.select("program", "example_id", "score").join(train.select("example_id", "position"), "example_id")
    demos = evaluation.select_demos(scored, train, list(PROGRAMS), threshold=1.0)
    return demos.withColumn("rank", F.col("rank").cast("bigint"))


def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Document sources ranked by label quality within each language."""
    return selection.leaderboard(_label_runs(spark, sf), ["lang"]).select(
        "lang", "program", "accuracy", "n_examples", F.col("rank").cast("bigint").alias("rank"),
        "runner_up_accuracy", "is_winner", "gain",
    )


def leaderboard_summary(spark: SparkSession, sf: str) -> DataFrame:
    return selection.leaderboard_summary(_label_runs(spark, sf), ["lang"])


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    runs = _label_runs(spark, sf)
    return selection.run_metrics(runs, F.col("run_id"), ["accuracy"], ["n_examples", "metric_name"], ["lang"])


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    """A model per document language, with a champion (version 1) and a challenger (version 2)."""
    models = load(spark, sf, "documents").select(F.concat(F.lit("retriever_"), "lang").alias("model")).distinct()
    aliases = F.explode(F.array(
        F.struct(F.lit("champion").alias("alias"), F.lit(1).alias("version")),
        F.struct(F.lit("challenger").alias("alias"), F.lit(2).alias("version")),
    ))
    return models.select("model", aliases.alias("a")).select("model", "a.alias", "a.version")


def _label_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Per model: the champion is scored by the quality label, the challenger by absence of toxicity."""
    labelled = load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    both = F.explode(F.array(
        F.struct(F.lit("champion").alias("program"), F.col("quality").alias("score")),
        F.struct(F.lit("challenger").alias("program"), (1 - F.col("toxic")).alias("score")),
    ))
    scores = labelled.select(F.concat(F.lit("retriever_"), "lang").alias("model"), both.alias("s")).select("model", "s.program", "s.score")
    means = evaluation.mean_scores(scores, ["model", "program"])
    return selection.champion_challenger(means, "champion", "challenger", by=["model"])


def promote_alias(spark: SparkSession, sf: str) -> DataFrame:
    promoted = selection.promote(_registry(spark, sf), _label_gate(spark, sf))
    return promoted.withColumn("version", F.col("version").cast("bigint"))


def alias_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The version behind the champion alias of every model, after promotion."""
    registry = selection.promote(_registry(spark, sf), _label_gate(spark, sf))
    wanted = _registry(spark, sf).filter("alias = 'champion'").select("model", "alias")
    return selection.version_by_alias(registry, wanted).withColumn("version", F.col("version").cast("bigint"))


def version_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Run and language of the next version of each model, as tags."""
    best = best_per_group(_label_runs(spark, sf), ["lang"], [F.desc("accuracy"), F.asc("position")], 1)
    best = best.select(F.concat(F.lit("retriever_"), "lang").alias("model"), "run_id")
    fresh = selection.new_versions(_registry(spark, sf).select("model", "version"), best)
    tags = {"training_run_id": F.col("run_id"), "experiment_group": F.regexp_extract("model", "_(.*)$", 1)}
    return selection.version_tags(fresh, tags).withColumn("version", F.col("version").cast("bigint"))


def register_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best run of each language registered as the next version of its model."""
    best = best_per_group(_label_runs(spark, sf), ["lang"], [F.desc("accuracy"), F.asc("position")], 1)
    best = best.select(F.concat(F.lit("retriever_"), "lang").alias("model"), "run_id")
    return selection.register_best(_registry(spark, sf), best).withColumn("version", F.col("version").cast("bigint"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        text_elements, html_elements, normalize_elements, element_text, section_breaks, element_sections,
        token_counts, chunks, json_chunks, chunk_ids, chunk_type_stats, atomic_overflow, docs_without_chunks,
        variant_paths, file_name, expectation_report,
        topk_cosine, topk_cells, ann_topk, ann_recall, embed_chunks, index_snapshot, index_stats, chunk_changes, index_sync,
        rerank_topk, rerank_late, format_hits,
        stream_chunks, stream_index, stream_versions, ingest_files, layout_stats,
        history_pairs, history_recent, history_nested, history_gapped, stream_history, current_question, plain_questions, validate_requests,
        rag_context, rag_inputs, rag_answers, coerce_response,
        qa_examples, split_full, split_test_mode, judge_score, token_f1, mean_accuracy, eval_grid,
        baseline_gain, champion_challenger, demo_select, leaderboard, leaderboard_summary, run_metrics,
        promote_alias, alias_lookup, register_best, version_tags,
    )
}
