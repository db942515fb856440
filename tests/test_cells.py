import numpy as np
import pytest

from lodestrata.operators import cells, embedding, index, search


def table(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "item long, vector array<float>").repartition(3)


def data(n=300, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(i, centres[rng.integers(12)] + 0.3 * rng.normal(size=dim)) for i in range(n)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # copies of one vector
    return [*rows, (2000, np.zeros(dim))]


def unit(v):
    v = np.asarray(v, np.float32).astype(np.float64)
    n = np.linalg.norm(v)
    return v / n if n else v


def brute(spark, root, queries, live, k, areas, near):
    """The best of the visited cells, from all vectors."""
    pivots = cells._pivots(spark, root)
    placed = {i: int(pivots.assign(unit(v)[None])[1][0]) for i, v in live}
    out = {}
    for q, v in queries:
        visited = set(pivots.visits(unit(v)[None], areas, near)[0].tolist())
        scores = sorted((-round(float(unit(v) @ unit(w)), 6), i) for i, w in live if placed[i] in visited)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append((r["item"], r["score"]))
    return out


def same(got, want):
    assert got.keys() == {q for q, hits in want.items() if hits}
    for q, hits in got.items():
        assert [i for i, _ in hits] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in hits], [s for _, s in want[q]], atol=1.1e-6)


@pytest.mark.parametrize("areas,near,block", [(2, 3, None), (9, 99, None), (2, 4, 512)])
def test_hits_are_the_best_of_the_visited_cells(spark, tmp_path, monkeypatch, areas, near, block):
    if block:
        monkeypatch.setattr(cells, "BLOCK_BYTES", block)  # cells are cut into many blocks
    root, rows = str(tmp_path), data()
    cells.build_cells(table(spark, rows), root)
    queries = rows[::7] + [(3000, np.zeros(8))]
    asked = table(spark, queries).withColumnRenamed("item", "query")
    want = brute(spark, root, queries, rows, 4, areas, near)
    same(found(cells.search_cells(asked, root, 4, areas, near)), want)
    if near == 99:  # all cells: the exact result
        exact = search.top_k(asked, table(spark, rows), 4, "query", "item", "vector")
        assert found(exact) == found(cells.search_cells(asked, root, 4, areas, near))


def test_batches_extend_and_take_away(spark, tmp_path):
    root, rows = str(tmp_path), data()
    cells.build_cells(table(spark, rows[:200]), root)
    for _ in range(2):  # a repeated batch replaces its rows
        cells.add_vectors(table(spark, rows[200:]), root, 1)
        cells.remove_vectors(table(spark, rows[::3]).select("item"), root, 2)
    cells.add_vectors(table(spark, rows[:3]), root, 2)  # one of them comes back
    live = [r for n, r in enumerate(rows) if n % 3 or n == 0]
    asked = table(spark, rows[::5]).withColumnRenamed("item", "query")
    got, want = found(cells.search_cells(asked, root, 3, 2, 5)), brute(spark, root, rows[::5], live + rows[1:3], 3, 2, 5)
    assert {q: {i for i, _ in hits} for q, hits in got.items()}.keys() == want.keys()
    assert all({i for i, _ in hits} <= {i for i, _ in live} for hits in got.values())


def test_change_log_of_an_index_extends_the_cells(spark, tmp_path):
    embedder, root, kept = embedding.hashing_embedder(32), str(tmp_path / "index"), str(tmp_path / "cells")

    def chunks(texts):
        shape = "chunk_id string, path string, chunk_pos int, chunk_section string, chunk_type string, chunk_content string"
        return spark.createDataFrame([(t, "p", i, "s", "final", t) for i, t in enumerate(texts)], shape)

    texts = [f"word{i % 9} word{i % 7} word{i % 5}" for i in range(60)]
    texts = sorted(set(texts))
    index.build_index(chunks(texts), embedder, root)
    live = index.current_index(spark, root)
    cells.build_cells(live.selectExpr("chunk_id AS item", "embedding AS vector"), kept)
    index.sync_index(spark, root, chunks([*texts[10:], "something new", "word1 new"]), embedder, 1)
    assert cells.extend_cells(index.read_log(spark, root), kept) == 1
    assert cells.extend_cells(index.read_log(spark, root), kept) == 1
    live = index.current_index(spark, root)
    held = cells._live(spark, kept)
    assert sorted(r[0] for r in held.select("item").collect()) == sorted(r[0] for r in live.select("chunk_id").collect())
    asked = live.selectExpr("chunk_id AS query", "embedding AS vector")
    got = found(cells.search_cells(asked, kept, 1, 99, 999))
    assert all(hits[0][1] == 1.0 for hits in got.values()) and len(got) == live.count()


def test_only_visited_folders_are_read(spark, tmp_path):
    root, rows = str(tmp_path), data()
    cells.build_cells(table(spark, rows), root)
    asked = table(spark, rows[:1]).withColumnRenamed("item", "query")
    plan = cells.search_cells(asked, root, 2, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(area" in plan or "PartitionFilters: [(area" in plan or "area#" in plan.split("PartitionFilters", 1)[1][:80]


def test_pivots_need_vectors(spark, tmp_path):
    with pytest.raises(ValueError):
        cells.build_cells(table(spark, []), str(tmp_path))
