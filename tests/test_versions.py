import os
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import chunking, elements
from lodestrata.operators import embedding, index
from lodestrata.sources import documents
from lodestrata.streaming import medallion, versions

OPTIONS = chunking.ChunkOptions(max_size=12, min_size=4)
EMBEDDER = embedding.hashing_embedder(32)
CHUNK = ["path", "chunk_pos", "chunk_section", "chunk_type", "chunk_id", "chunk_content"]


def chunked(rows):
    rendered = rows.withColumn("elements", elements.render_typed(documents.text_elements(F.coalesce("text", F.lit("")))))
    return chunking.with_chunks(rendered, "elements", OPTIONS)


def snapshot(spark, docs):
    rows = spark.createDataFrame(list(docs.items()) or [], "path string, text string")
    return rows.withColumn("fingerprint", F.md5("text"))


def advance(spark, root, docs, max_files=None):
    versions.record_versions(snapshot(spark, docs), f"{root}/log")
    return carry(spark, root, max_files)


def carry(spark, root, max_files=None):
    seen = versions.version_stream(spark, f"{root}/log", "path string, text string", max_files)
    with versions.keyed_state(spark):
        medallion.run_available(versions.chunk_changes(chunked(seen)), f"{root}/changes", f"{root}/cp/changes")
    gained = versions.occurrence_stream(spark, f"{root}/changes", max_files)
    return versions.sync_changes(gained, f"{root}/index", EMBEDDER, f"{root}/cp/index")


def expected(spark, docs):
    return chunking.explode_chunks(chunked(snapshot(spark, docs))).select(*CHUNK)


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def checked(spark, root, live, docs):
    chunks = expected(spark, docs)
    assert rows(versions.live_chunks(spark.read.parquet(f"{root}/changes")), CHUNK) == rows(chunks, CHUNK)
    columns = [*index.ROW]
    assert rows(live, columns) == rows(index.index_rows(chunks), columns)
    vectors = {r["chunk_id"]: list(r["embedding"]) for r in live.collect()}
    fresh = index.embed_index(index.index_rows(chunks), EMBEDDER).collect()
    assert vectors == {r["chunk_id"]: list(r["embedding"]) for r in fresh}


def text(rng, shared):
    lines = [f"{' '.join(f'w{rng.randrange(60)}' for _ in range(rng.randrange(3, 25)))}" for _ in range(rng.randrange(1, 6))]
    return "\n".join(["# Head", *lines, *([shared] if rng.random() < 0.6 else [])])


@pytest.mark.parametrize("max_files", [None, 1])
def test_index_follows_changed_and_removed_documents(spark, tmp_path, max_files):
    rng, root = random.Random(4), str(tmp_path)
    shared = "a closing line that most of the documents have in common " * 2
    docs = {f"d{i:02}": text(rng, shared) for i in range(14)}
    checked(spark, root, advance(spark, root, docs, max_files), docs)
    docs = {p: t if rng.random() < 0.5 else text(rng, shared) for p, t in docs.items() if rng.random() < 0.7} | {"a new one": text(rng, shared)}
    checked(spark, root, advance(spark, root, docs, max_files), docs)
    assert spark.read.parquet(f"{root}/log").where("scan = 1").count() < len(docs) + 14  # unchanged ones are not recorded again
    docs = {"d03": docs.get("d03", "back again")}  # the lowest place of the shared line is lost
    checked(spark, root, advance(spark, root, docs, max_files), docs)
    live = advance(spark, root, {})
    assert live.count() == 0 and versions.live_chunks(spark.read.parquet(f"{root}/changes")).count() == 0
    docs = {"d03": "back again " * 9}
    checked(spark, root, advance(spark, root, docs), docs)


def test_nothing_new_changes_nothing(spark, tmp_path):
    root, docs = str(tmp_path), {"a": "one two three four five six seven", "b": "eight nine ten eleven twelve"}
    advance(spark, root, docs)
    batches = index.listed(spark, f"{root}/index")
    advance(spark, root, docs)
    assert index.listed(spark, f"{root}/index") == batches
    assert spark.read.parquet(f"{root}/changes").count() == 2


def test_null_and_empty_texts_and_one_text_in_many_documents(spark, tmp_path):
    root = str(tmp_path)
    docs = {f"p{i}": "the same words in every one of these documents, all of them" for i in range(30)} | {"none": None, "empty": ""}
    assert {r["path"] for r in advance(spark, root, docs).collect()} == {"p0", "empty"}  # null and empty texts are one blank chunk
    del docs["p0"], docs["p1"]
    assert {r["path"] for r in advance(spark, root, docs).collect()} == {"p10", "empty"}


def test_late_versions_are_left_out(spark, tmp_path):
    root = str(tmp_path)
    for scan, docs in enumerate([{"a": "first words of the document here"}, {"a": "second words of the document here"}]):
        versions.record_versions(snapshot(spark, docs), f"{root}/log")
    os.rename(f"{root}/log/scan=0", f"{root}/later")
    carry(spark, root)
    os.rename(f"{root}/later", f"{root}/log/scan=0")
    assert [r["chunk_content"] for r in carry(spark, root).collect()] == ["[TITLE] second words of the document here"]


def test_folder_scan_takes_changed_files_only(spark, tmp_path):
    inbox, log = tmp_path / "inbox", str(tmp_path / "log")
    inbox.mkdir()
    for name in "abc":
        (inbox / f"{name}.txt").write_text(name)
        os.utime(inbox / f"{name}.txt", (1000, 1000))
    assert versions.scan_folder(spark, str(inbox), log, "*.txt") == 0
    (inbox / "a.txt").unlink()
    (inbox / "b.txt").write_text("longer")
    os.utime(inbox / "b.txt", (900, 900))  # an older file in place of a newer one is a change too
    assert versions.scan_folder(spark, str(inbox), log, "*.txt") == 1
    assert versions.scan_folder(spark, str(inbox), log, "*.txt") == 1  # nothing new, nothing written
    got = {(r["scan"], r["path"].rsplit("/", 1)[1], r["present"], r["content"] and bytes(r["content"])) for r in spark.read.parquet(log).collect()}
    assert got == {(0, f"{n}.txt", True, n.encode()) for n in "abc"} | {(1, "a.txt", False, None), (1, "b.txt", True, b"longer")}


def test_claims_of_several_writers(spark, tmp_path):
    root = str(tmp_path)
    assert [index.claim_batch(spark, root, "one", str(i)) for i in (0, 0, 1)] == [0, 0, 1]
    assert index.claim_batch(spark, root, "two.x", "0") == 2
    assert index.claim_batch(spark, root, "one", "1") == 1
    assert index.claim_batch(spark, root, "one", "2") == 3
    assert len(index.listed(spark, f"{root}/_claims")) <= 4


class _Held:
    """A value and a map of a state store that counts its calls."""

    def __init__(self):
        self.value, self.map, self.calls = None, {}, 0

    def getValueState(self, *_):  # noqa: N802
        return self

    getMapState = getValueState  # noqa: N815

    def _called(self, result=None):
        self.calls += 1
        return result

    def get(self):
        return self._called(self.value)

    def update(self, value):
        self.value = self._called(value)

    def clear(self):
        self.value = self._called()

    def containsKey(self, key):  # noqa: N802
        return self._called(key in self.map)

    def updateValue(self, key, value):  # noqa: N802
        self._called(self.map.__setitem__(key, value))

    def removeKey(self, key):  # noqa: N802
        self._called(self.map.pop(key))

    def keys(self):
        return self._called(iter(list(self.map)))


def test_a_bucket_costs_two_calls_to_the_state_however_many_keys_change():
    held, processor = _Held(), versions._ChunkPlaces()
    processor.init(held)
    rows = [
        {"chunk_id": f"c{i % 40}", "path": f"p{i:03}", "chunk_pos": 0, "chunk_section": None, "chunk_type": "final", "chunk_content": f"t{i % 40}", "version": 0, "present": True}
        for i in range(200)
    ]
    out = list(processor.handleInputRows((3,), iter(rows), None))
    assert held.calls == 2 and len(out) == 40
    assert {(r["chunk_id"], r["change"], r["path"], r["chunk_content"]) for r in out} == {(f"c{i}", "insert", f"p{i:03}", f"t{i}") for i in range(40)}
    held, processor = _Held(), versions._DocumentChunks()
    processor.init(held)
    chunk = {"chunk_id": "c", "chunk_pos": 0, "chunk_section": "s", "chunk_type": "final", "chunk_content": "t"}
    docs = [{"path": f"p{i}", "version": v, "chunks": [chunk] if v else []} for i in range(30) for v in (1, 0)]
    assert len(list(processor.handleInputRows((3,), iter(docs), None))) == 30
    assert held.calls == 2


@pytest.mark.parametrize("seed", range(3))
def test_places_of_a_text_follow_plain_code(monkeypatch, seed):
    """More places than stand with the text, nulls among them, added and removed in any order, also without being there."""
    monkeypatch.setattr(versions, "LOWEST", 3)
    rng, held, plain = random.Random(seed), _Held(), {}
    processor = versions._ChunkPlaces()
    processor.init(held)
    for version in range(60):
        rows, before = [], {c: min(p, key=versions._order) for c, p in plain.items() if p}
        for chunk in rng.sample("abc", 2):
            for _ in range(rng.randrange(1, 6)):
                place = (rng.choice([None, *"mnopqrst"]), rng.randrange(2), None, "final")
                rows.append({"chunk_id": chunk, **dict(zip(index.PLACE, place)), "chunk_content": chunk, "version": version, "present": rng.random() < 0.5})
        for row in sorted(rows, key=lambda r: r["present"]):
            place = tuple(row[c] for c in index.PLACE)
            (plain.setdefault(row["chunk_id"], set()).add if row["present"] else plain.setdefault(row["chunk_id"], set()).discard)(place)
        after = {c: min(p, key=versions._order) for c, p in plain.items() if p}
        got = {r["chunk_id"]: (r["change"], *(r[c] for c in index.PLACE)) for r in processor.handleInputRows((0,), iter(rows), None)}
        want = {}
        for c in {*before, *after}:
            if before.get(c) != after.get(c):
                want[c] = ("insert" if c not in before else "delete" if c not in after else "update", *after.get(c, (None,) * 4))
        assert got == want
        texts = held.value[0] if held.value else []
        assert {t[0]: len(t[1]) + t[2] for t in texts} == {c: len(p) for c, p in plain.items() if p}
        assert len(held.map) == sum(t[2] for t in texts)
