import json
import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.functions import chunking, elements, sizes
from lodestrata.functions.chunking import ChunkOptions
from tests.fold_model import model_chunks

T = lambda n: ("text", "x" * (4 * n))
H = lambda x: ("section_header", x)
P = lambda x: ("title", x)
TB40 = ("table", "y" * 40)

GOLDEN = [
    (10, 4, [], []),
    (10, 4, [T(2)], [(1, "Introduction", "small_final")]),
    (10, 4, [T(4)], [(1, "Introduction", "final")]),
    (10, 4, [T(6), T(4)], [(2, "Introduction", "final")]),
    (10, 4, [T(6), T(5)], [(1, "Introduction", "size_limited"), (1, "Introduction", "final")]),
    (10, 4, [T(25)], [(1, "Introduction", "final")]),
    (10, 4, [P("A"), T(5), H("B"), T(5)], [(2, "A", "section_based"), (2, "B", "final")]),
    (10, 4, [T(2), T(9), H("B")], [(1, "Introduction", "small_size"), (1, "Introduction", "section_based"), (1, "B", "final")]),
    (10, 4, [T(3), T(8), T(3)], [(1, "Introduction", "small_size"), (2, "Introduction", "merged")]),
    (10, 4, [T(8), TB40, T(1)], [(3, "Introduction", "merged")]),
    (8, 6, [T(5), T(5), T(5)], [(1, "Introduction", "small_size"), (1, "Introduction", "small_size"), (1, "Introduction", "small_final")]),
    (8, 6, [T(5), T(5), H("B")], [(1, "Introduction", "small_size"), (2, "Introduction", "merged")]),
    (8, 6, [T(5), T(5), H("Zz"), T(7)], [(1, "Introduction", "small_size"), (2, "Introduction", "merged"), (1, "Zz", "final")]),
]


def as_json(items):
    return json.dumps([{"type": k, "content": c} for k, c in items])


def run_json(spark, payloads, options):
    df = spark.createDataFrame(list(enumerate(payloads)), "id int, j string")
    rows = df.select("id", chunking.json_chunks("j", options).alias("c")).collect()
    return {r["id"]: None if r["c"] is None else [tuple(x) for x in r["c"]] for r in rows}


def test_golden_cases(spark):
    for limits in {(m, n) for m, n, _, _ in GOLDEN}:
        cases = [(e, want) for m, n, e, want in GOLDEN if (m, n) == limits]
        got = run_json(spark, [as_json(e) for e, _ in cases], ChunkOptions(*limits))
        for i, (_, want) in enumerate(cases):
            assert [(len(c.split("\n\n")), s, k) for c, s, k in got[i]] == want


BAD = [
    None, "", "{bad", "null", "5", '"x"', "[1,2]", "[null]", '{"elements": null}', '{"elements": {}}',
    '{"elements": "abc"}', '[{"type":"text","content":null}]', '[{"content":5}]', '[{"type":"text","content":"a"},3]',
    '[{"type":"figure","content":null}]', '[{"type":"figure","content":"a","description":{"b":1}}]', "[]", '{"elements":[]}',
]


def test_bad_input_gives_no_chunks(spark):
    assert set(map(str, run_json(spark, BAD, ChunkOptions(10, 4)).values())) == {"[]"}


RENDERED = [
    ({"type": "figure", "content": "c", "description": "d"}, "[FIGURE] c\nd"),
    ({"type": "figure", "content": "", "description": "d"}, "[FIGURE] d"),
    ({"type": "figure", "content": None, "description": "d"}, "[FIGURE] d"),
    ({"type": "figure", "description": "d"}, "[FIGURE] d"),
    ({"type": "figure", "content": "c", "description": ""}, "c"),
    ({"type": "figure", "content": "c", "description": None}, "c"),
    ({"type": "figure", "content": "c"}, "c"),
    ({"type": "table", "content": "c"}, "[TABLE] c"),
    ({"type": "table", "content": None}, "[TABLE] None"),
    ({"type": "table"}, "[TABLE] "),
    ({"type": "title", "content": None}, "[TITLE] None"),
    ({"type": "section_header", "content": "c"}, "[SECTION_HEADER] c"),
    ({"type": "Title", "content": "c"}, "c"),
    ({"type": None, "content": "c"}, "c"),
    ({"content": "c"}, "c"),
    ({"type": "text"}, ""),
    ({"type": "text", "content": 7}, None),
    ({"type": "text", "content": None}, None),
]


def test_element_text_table(spark):
    df = spark.createDataFrame([(i, json.dumps([e])) for i, (e, _) in enumerate(RENDERED)], "id int, j string")
    got = {r["id"]: r["e"][0]["text"] for r in df.select("id", elements.render_json("j").alias("e")).collect()}
    assert [got[i] for i in range(len(RENDERED))] == [want for _, want in RENDERED]


def test_typed_and_json_rendering_agree(spark):
    plain = [e for e, want in RENDERED if want is not None and e.get("content", "") is not None and e.get("type", "") is not None]
    rows = [(i, [(e.get("type"), e.get("content"), e.get("description"))], json.dumps([e])) for i, e in enumerate(plain)]
    df = spark.createDataFrame(rows, f"id int, t array<{elements.TYPED_ELEMENT}>, j string")
    for r in df.select(elements.render_typed(F.col("t")).alias("a"), elements.render_json("j").alias("b")).collect():
        assert r["a"] == r["b"]


def test_container_shapes(spark):
    one = {"type": "text", "content": "abcd"}
    got = run_json(spark, [json.dumps(x) for x in ([one], {"elements": [one]}, one)], ChunkOptions(10, 0))
    assert got[0] == got[1] == got[2] == [("abcd", "Introduction", "final")]


def test_label_drops_every_prefix(spark):
    payload = json.dumps([{"type": "title", "content": "[TITLE] a [TITLE] b [TABLE] "}, {"content": "c" * 40}])
    assert run_json(spark, [payload], ChunkOptions(10, 0))[0][0][1] == "a b [TABLE] "


def test_sizes_of_blank_and_wide_text(spark):
    texts = ["", " \t\n ", " " * 9, " " * 9, "\x1c\x1d\x1e\x1f" * 3, "abc", "abcd", "é" * 9, "😀" * 8, None, " a  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [r["n"] for r in df.select("id", sizes.chars_div_4(F.col("t")).alias("n")).orderBy("id").collect()]
    sql = [r["n"] for r in df.selectExpr("id", f"{sizes.chars_div_4_sql('t')} AS n").orderBy("id").collect()]
    assert got == sql == [0 if t is None or not t.strip() else len(t) // 4 for t in texts]


items = st.lists(
    st.tuples(
        st.sampled_from(["text", "text", "text", "table", "figure", "title", "section_header", "list"]),
        st.one_of(st.integers(0, 60).map(lambda n: "w" * n), st.text(max_size=20)),
    ),
    max_size=25,
)


@pytest.mark.parametrize("block", [chunking.MIN_BLOCK, 1])
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=st.lists(items, min_size=10, max_size=40), limits=st.tuples(st.integers(0, 12), st.integers(0, 12)))
def test_fold_equals_model(spark, monkeypatch, block, docs, limits):
    monkeypatch.setattr(chunking, "MIN_BLOCK", block)
    low, high = min(limits), max(limits)
    # JSON text cannot hold lone surrogates
    docs = [[(k, c.encode("utf-8", "ignore").decode()) for k, c in d] for d in docs]
    got = run_json(spark, [as_json(d) for d in docs], ChunkOptions(high, low))
    for i, d in enumerate(docs):
        assert got[i] == model_chunks(d, high, low)


def test_documents_of_many_blocks_equal_model(spark):
    rng = random.Random(4)
    kinds = ["text"] * 8 + ["table", "title", "section_header"]
    docs = [[(rng.choice(kinds), "w" * rng.randint(0, 80)) for _ in range(n)] for n in (63, 64, 65, 128, 129, 5000)]
    docs += [[("text", "w" * rng.randint(0, 30)) for _ in range(3000)], [("table", "w" * 40)] * 700]
    got = run_json(spark, [as_json(d) for d in docs], ChunkOptions(25, 10))
    assert [got[i] for i in range(len(docs))] == [model_chunks(d, 25, 10) for d in docs]


def test_a_document_with_very_many_elements_is_cheap(spark):
    df = spark.range(1).select(
        F.transform(
            F.sequence(F.lit(1), F.lit(60000)),
            lambda i: F.struct(
                F.when(i % 40 == 0, "title").otherwise("text").alias("kind"), F.repeat(F.lit("x"), i % 37).alias("text")
            ),
        ).alias("elements")
    )
    start = time.perf_counter()
    out = chunking.with_chunks(df, "elements", ChunkOptions(20, 5)).select(F.size("chunks").alias("n")).first()["n"]
    # a single fold would take about a minute
    assert out > 10000 and time.perf_counter() - start < 20


def test_options_are_checked():
    for bad in ((-5, -6), (5, 6), (5, -1)):
        with pytest.raises(ValueError):
            ChunkOptions(*bad)
    assert (ChunkOptions().max_size, ChunkOptions().min_size) == (4000, 400)


def test_sql_function(spark):
    chunking.register_chunk_function(spark, ChunkOptions(10, 0), "cut")
    row = spark.sql("""SELECT cut('[{"type":"title","content":"A"},{"content":"b"}]') AS c""").first()
    assert [tuple(x) for x in row["c"]] == [("[TITLE] A\n\nb", "A", "final")]


def test_tokenizer_measure(spark):
    measure = sizes.tokenizer_sizes(lambda: lambda text: len(text.split()))
    df = spark.createDataFrame([(1, [("text", "a b c"), ("text", "d e"), ("text", "  ")])], "id int, elements array<struct<kind:string,text:string>>")
    out = chunking.with_chunks(df, "elements", ChunkOptions(4, 0, measure)).first()["chunks"]
    assert [tuple(c) for c in out] == [("a b c", "Introduction", "size_limited"), ("d e\n\n  ", "Introduction", "final")]


def test_model_tokenizers(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = Tokenizer(models.WordLevel({"[UNK]": 0}, unk_token="[UNK]"))
    words.pre_tokenizer = pre_tokenizers.Whitespace()
    home = tmp_path / "BAAI" / "bge-large-en-v1.5"
    home.mkdir(parents=True)
    words.save(str(home / "tokenizer.json"))
    df = spark.createDataFrame([(["one two three", "x" * 20],)], "t array<string>")

    def measured(model):
        return df.select(sizes.model_sizes(model, str(tmp_path))(F.col("t")).alias("n")).first()["n"]

    assert measured("bge_large_en_v1_5") == [3, 1]
    # no file there, or no tokenizer known: the default measure
    assert sizes.model_sizes("gte-large-en-v1.5", str(tmp_path)) is None
    assert sizes.model_sizes("text-embedding-ada-002", str(tmp_path)) is None
    (home / "tokenizer.json").write_text("{damaged")
    with pytest.raises(Exception, match="expected|key"):
        sizes.model_sizes("bge-large-en-v1.5", str(tmp_path))


def test_section_labels(spark):
    df = spark.createDataFrame(
        [(1, [("text", "a"), ("title", "[TITLE] X"), ("text", "b"), ("table", "c"), ("section_header", "[SECTION_HEADER] Y")]), (2, []), (3, [("title", "[TITLE] Z")])],
        "id int, elements array<struct<kind:string,text:string>>",
    )
    got = [r["l"] for r in df.select("id", chunking.section_labels("elements").alias("l")).orderBy("id").collect()]
    assert got == [["Introduction", "X", "X", "X", "Y"], [], ["Z"]]


def test_chunk_plan_runs_the_fold_once_and_without_python(spark, sf):
    from lodestrata.plans.catalogue import QUERIES

    plan = QUERIES["chunks"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "Exchange" not in plan
    assert plan.count("small_final") == 1
