import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from lodestrata.llm import bpe, licences, quality_rules, sharding, topk, toxicity
from lodestrata.llm.words import WordHashes
from tests.llm import cases
from tests.llm.test_sets_and_spans import words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# byte-level BPE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(VOCABULARY), special_tokens={})


@pytest.mark.parametrize("limit", [1 << 20, 40])  # 40: most words are encoded in their rows
def test_ids_match_the_library_and_decode(spark, library, limit):
    data = cases.rows() + [(800 + i, t, "en", "s") for i, t in enumerate(["it's we'll  x", " lead", "trail ", "a\n b", "\x85 c d", "<|endoftext|>", "😀😀 é́"])]
    rows = bpe.round_trip(cases.documents(spark, data), VOCABULARY, PATTERN, limit).collect()
    got = sorted(((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in rows), key=repr)
    assert got == sorted(((d, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for d, t, *_ in data), key=repr)


def test_tokens_of_nothing(spark):
    assert bpe.digests(cases.empty(spark), VOCABULARY, PATTERN).count() == 0


def test_long_pieces(library):
    ranks, rng = bpe.load_ranks(VOCABULARY), random.Random(1)
    for n in (1, 2, 90, 400, 3000):
        for word in (b"a" * n, bytes(rng.choice(b"abcde the ing") for _ in range(n)), bytes(rng.randrange(256) for _ in range(n))):
            assert bpe.merge_long(word, ranks) == library._core_bpe.encode_single_piece(word)


def test_parts_split_into_the_same_pieces():
    rng, splitter = random.Random(3), bpe.Splitter(PATTERN)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "é", "1", "!", "'s", " ", "  ", "\n", "\t", " ", " ", "\x1c", "　", "漢"]) for _ in range(rng.randrange(12)))
        first, *rest = text.split(" ")
        if not any(map(splitter.is_glued, rest)):  # other texts are split as a whole
            assert [*splitter.pieces(first, False), *(p for word in rest for p in splitter.pieces(word, True))] == splitter.find(text), repr(text)


def test_tasks_that_decode_get_the_ranks_without_the_dictionary(spark):
    _, known, ranks = bpe._encoded(cases.documents(spark), VOCABULARY, PATTERN, bpe.DICTIONARY_WORDS)
    assert isinstance(known.value, bpe.Dictionary) and ranks.value == bpe.load_ranks(VOCABULARY)


def test_slices_of_texts_are_encoded_as_by_the_library(library):
    rng, ranks = random.Random(4), bpe.load_ranks(VOCABULARY)
    known = {w: library._core_bpe.encode_single_piece(w) for w in (b"a", b" a", b" the", "é".encode(), b"!!")}
    hashes = np.array([bpe.xxhash.xxh3_64_intdigest(w) for w in known], np.uint64)
    entries = bpe.Dictionary(hashes, np.array(list(map(len, known.values())), np.uint8), np.array(sum(known.values(), []), np.int32))
    encoder = bpe.Encoder(entries, ranks, PATTERN)
    for _ in range(50):
        parts = ["a", "é", "1", "!!", "'s", " ", "  ", "\n", "the", " the", " ", "x" * 200, "word"]
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 9))]
        ids, ends, rare = encoder.encode(bpe.pa.array([*texts, None], bpe.pa.string()))
        for text, a, b in zip([*texts, ""], ends, ends[1:]):
            got = [x for i in ids[a:b].tolist() for x in (library.encode_ordinary(rare[-i - 1]) if i < 0 else [i])]
            assert got == library.encode_ordinary(text), repr(text)


def test_letters_are_one_piece():
    splitter = bpe.Splitter(PATTERN)
    letters = [chr(c) for c in range(0x180) if bpe._LETTERS(chr(c))]
    assert len(letters) == 52 + 23 + 31 + 8 + 128 and splitter.find("".join(letters)) == ["".join(letters)]


def test_other_patterns_and_colliding_words(spark, monkeypatch):
    data = [(1, "Hello World 12345 it's", "en", "s"), (2, "hello  world\n", "en", "s")]
    pattern = r"\p{Lu}?\p{Ll}+|\p{N}{1,3}|\s+|[^\s\p{L}\p{N}]+"
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(VOCABULARY), special_tokens={})
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(cases.documents(spark, data), VOCABULARY, pattern).collect()}
    assert got == {d: own.encode_ordinary(t) for d, t, *_ in data}
    entry = bpe.Dictionary(np.array([bpe.xxhash.xxh3_64_intdigest(b"abc")], np.uint64), np.array([2], np.uint8), np.array([0, 1], np.int32))
    assert entry.places([b"abc", b"c"], bpe.Tokens({b"ab": 0, b"c": 1}))[1].tolist() == [2, 0]
    assert entry.places([b"abc"], bpe.Tokens({b"ab": 0, b"x": 1}))[1].tolist() == [0]


# sharding


def test_shards_hold_nearly_equal_bytes(spark):
    data = cases.rows()
    rows = sharding.kd_shards(cases.documents(spark, data)).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in data), key=repr)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_shards_of_even_rows_and_a_hot_copy(spark):
    rng = random.Random(9)
    data = [(i, "same text", "en", "a") if i % 3 == 0 else (i, cases.prose(rng, rng.randrange(5, 40)), "en", f"s{i % 7}") for i in range(1500)]
    rows = sharding.kd_shards(cases.documents(spark, data)).collect()
    sizes = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows], 16)
    most = max(r["size"] for r in rows)
    # each of the four cuts is off by less than one row
    assert sizes.max() - sizes.mean() <= 2 * most and sizes.mean() - sizes.min() <= 2 * most
    again = sharding.kd_shards(cases.documents(spark, data[::-1])).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)
    assert sharding.kd_shards(cases.empty(spark)).count() == 0


def plain_shards(data, levels=4):
    """The tree in plain code: rows sorted by the whole key, cut at the row that crosses the half."""

    def hashed(x):
        return 42 if x is None else xxhash.xxh64_intdigest(x if isinstance(x, bytes) else x.to_bytes(8, "little", signed=True), 42)

    def number(name):
        return None if name is None else float(int.from_bytes(name.encode()[:6].ljust(6, b"\0"), "big"))

    rows, seen, first = [], Counter(), {}
    for _, text, lang, source in data:
        old = first.get(text or "", (None, None))
        first[text or ""] = tuple(min((x for x in pair if x is not None), default=None) for pair in zip(old, (source, lang)))
    for d, text, _, _ in data:
        raw = (text or "").encode()
        source, lang = first[text or ""]
        dims = [float(len(raw) + 1), number(source), number(lang)]
        rows.append([d, len(raw) + 1, zlib.crc32(raw), dims, hashed(raw), hashed(d), seen[d, text or ""], 0])
        seen[d, text or ""] += 1
    spans = [(min(own), max(own)) if (own := [r[3][i] for r in rows if r[3][i] is not None]) else (0, 0) for i in range(3)]

    def scaled(row, i):
        lo, hi = spans[i]
        return 0 if hi <= lo or row[3][i] is None else math.floor((row[3][i] - lo) / (hi - lo) * float((1 << 31) - 2)) + 1

    for _ in range(levels):
        for node, own in [(n, [r for r in rows if r[7] == n]) for n in {r[7] for r in rows}]:
            widths = [max(scaled(r, i) for r in own) - min(scaled(r, i) for r in own) for i in range(3)]
            widest = max(range(3), key=lambda i: (widths[i], -i))
            own.sort(key=lambda r: (scaled(r, widest), r[2], r[4], r[5], r[6]))
            half, before = sum(r[1] for r in own) / 2, 0
            for at, row in enumerate(own):
                if before + row[1] >= half:
                    break
                before += row[1]
            stays = abs(before + row[1] - half) <= abs(before - half)
            for i, r in enumerate(own):
                r[7] = 2 * node + (i > at or i == at and not stays)
    return sorted(((r[0], r[1], r[2], r[7]) for r in rows), key=repr)


@pytest.mark.parametrize("repeats", [0, 700])
def test_shards_equal_plain_code(spark, repeats):
    rng = random.Random(12)
    data = cases.rows()
    data += [(1000 + i, cases.prose(rng, rng.randrange(1, 30)), rng.choice(["en", "de", None]), rng.choice(["web", "books", "news"])) for i in range(500)]
    data += [(5000 + i, "one text of several sources", "en", f"s{i}") for i in range(30)]
    data += [(7, "a row that is half of the table " * 3, "en", "web")] * repeats
    rows = sharding.kd_shards(cases.documents(spark, data)).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in rows), key=repr) == plain_shards(data)
    sizes = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows], 16)
    assert repeats == 0 or np.ptp(sizes[np.arange(16)]) <= 2 * max(r["size"] for r in rows)
    of_text = {}
    for r in rows:
        of_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert sum(len(s) > 1 for s in of_text.values()) <= 15  # at most one group a cut
    for shard in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_leaves_reach_the_target_bytes(spark):
    data = [(i, "x" * (i % 50), "en", "s") for i in range(400)]
    total = sum(i % 50 + 1 for i in range(400))
    for target in (total, total // 2, 1000):
        rows = sharding.kd_shards(cases.documents(spark, data), target_bytes=target).collect()
        sizes = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows])
        assert sizes.max() <= target + 100


# exact top-k


def test_top_k_matches_brute_force(spark):
    rng = random.Random(4)
    vectors = [(i, [rng.choice([0.0, 0.5, -0.25, rng.gauss(0, 1)]) for _ in range(6)]) for i in range(120)]
    vectors += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (204, []), (205, [0.5]), (None, [1.0] * 6)]
    vectors += [(7, [9.0] * 6), (50, [2.0] * 6), (210, [0.0] * 6), (250, [1e30] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, id int")
    valid = topk.valid_vectors(df, "vec_id", "embedding")
    got = topk.exact_top_k(valid.where("id % 50 = 0"), valid, 5).collect()
    good = [(i, [int(min(max(np.floor(256 * float(np.float32(x))), -(2**62)), 2**62)) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in good:
        if q % 50 == 0:
            found = [(sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q]
            want += [(q, n + 1, i, min(max(s, -(2**63)), 2**63 - 1)) for n, (s, i) in enumerate(sorted(found, key=lambda x: (-x[0], x[1]))[:5])]
    kept = lambda rows: sorted(r for r in rows if r[0] not in (50,) and 250 not in (r[0], r[2]))
    assert kept(tuple(r) for r in got) == kept(want)
    assert len(got) == 5 * len({q for q, *_ in want})  # rows that repeat an id share one list


def test_top_k_of_nothing(spark):
    none = topk.valid_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert topk.exact_top_k(none, none, 5).count() == 0


# quality


def base_plainly(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
    return (*counts, len(w) < 10 or 100 * len(repeated) > 20 * len(w))


def test_base_rules_match_plain_code(spark):
    got = quality_rules.judged_documents(cases.documents(spark), cases.labels(spark))
    assert cases.found(got, "doc_id", *quality_rules.COUNTS, "base_failed") == sorted(((d, *base_plainly(t)) for d, t, *_ in cases.rows()), key=repr)
    assert got.where("base_failed AND kept").count() == 0
    assert quality_rules.judged_documents(cases.empty(spark), cases.labels(spark)).count() == 0
    none = cases.labels(spark).limit(0)
    assert quality_rules.judged_documents(cases.documents(spark), none).where("kept = base_failed").count() == 0


def test_forest_rejects_junk_and_keeps_clean_rows(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    got = quality_rules.judged_documents(docs, labels).join(labels, "doc_id").where("NOT base_failed").collect()
    rate = lambda q: np.mean([not r["kept"] for r in got if r["quality"] == q])
    assert rate(1) <= 0.01 and rate(0) > 5 * rate(1)
    kept = quality_rules.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.judged_documents(docs, labels).where("kept").count()


def test_expected_path_and_scores():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(500, 3)), [[9.0, 9.0, 9.0]]])
    scores = quality_rules.grow_forest(x).score(x)
    assert scores.argmax() == 500 and 0 < scores.min() < scores.max() < 1


# toxicity


def toxic_rows(n=900):
    rng = random.Random(11)
    bad = ["idiot", "trash", "moron"]
    out, known = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = cases.prose(rng, 40)
        if toxic:
            text = f"{text} {rng.choice(bad)}, {text[:9]} {rng.choice(bad).upper()}!"
        out.append((i, text, "en", "s"))
        known.append((i, 1, int(toxic)))
    return out, known


def test_held_out_toxic_rows_are_found(spark):
    data, known = toxic_rows()
    docs, labels = cases.documents(spark, data), spark.createDataFrame(known, cases.LABELS)
    rows = toxicity.toxicity(docs, labels).collect()
    assert {r["doc_id"] for r in rows if r["held_out"]} == {d for d, *_ in data if zlib.crc32(str(d).encode()) % 4 == 2}
    assert all(r["predicted"] == int(r["doc_id"] % 6 == 0) for r in rows)
    assert all(r["doc_id"] not in r["evidence"] and (r["evidence"] or not r["predicted"]) for r in rows)


def test_block_bounds_give_the_exact_neighbours(spark):
    data, known = toxic_rows(400)
    model = toxicity.fit(cases.documents(spark, data), spark.createDataFrame(known, cases.LABELS))
    rng = np.random.default_rng(2)
    rows = []
    for i in range(500):  # random vectors over a wide vocabulary
        at = np.sort(rng.choice(40, rng.integers(1, 9), replace=False))
        w = rng.random(len(at))
        rows.append({"doc_id": i, "toxic": i % 2, "at": at.astype(np.int64).tobytes(), "weights": (w / np.sqrt((w**2).sum())).tobytes()})
    model.vocabulary = {str(i).encode(): i for i in range(40)}
    model = toxicity._indexed(model, rows)
    dense = np.zeros((500, 40))
    for i, r in enumerate(rows):
        dense[i, np.frombuffer(r["at"], np.int64)] = np.frombuffer(r["weights"])
    for i in range(60):
        at, w = np.frombuffer(rows[i]["at"], np.int64), np.frombuffer(rows[i]["weights"])
        best, values = model.nearest(at, w, i, 7)
        sims = np.round(dense @ dense[i], 12)
        sims[i] = -1
        want = sorted(range(500), key=lambda j: (-sims[j], j))[:7]
        assert model.ids[best].tolist() == want and np.allclose(values, sims[want])


def test_copies_of_toxic_texts_without_common_toxic_words_are_found(spark):
    data, known = toxic_rows()
    rng = random.Random(31)
    letters = str.maketrans("0123456789", "abcdefghij")  # digits are no terms
    data = [(i, t.translate(letters), *rest) for i, t, *rest in data]
    odd = [i for i in range(5000, 5012) if zlib.crc32(str(i).encode()) % 4 != 2][:6]
    data += [(i, cases.prose(rng, 40).translate(letters), "en", "s") for i in odd]  # labelled toxic, all words in clean texts too
    known += [(i, 1, 1) for i in odd]
    copies = {6000 + n: next(t for d, t, *_ in data if d == i) for n, i in enumerate(odd)}
    data += [(i, t, "en", "s") for i, t in copies.items()]
    data += [(7000, "nothingshared atall", "en", "s")]
    rows = {r["doc_id"]: r for r in toxicity.toxicity(cases.documents(spark, data), spark.createDataFrame(known, cases.LABELS)).collect()}
    for copy, example in zip(copies, odd, strict=True):
        assert rows[copy]["predicted"] == 1 and rows[copy]["evidence"][0] == example
    assert rows[7000]["evidence"] == [] and rows[7000]["predicted"] == 0
    assert all(rows[i]["evidence"] for i in range(900))


def test_document_counts_cover_all_documents(spark):
    data, known = toxic_rows(300)
    data += [(9000 + i, "idiot moron moron", "en", "s") for i in range(500)] + [(None, "trash", "en", "s"), (None, None, "en", "s")]  # without labels
    model = toxicity.fit(cases.documents(spark, data), spark.createDataFrame(known, cases.LABELS))
    for term in (b"idiot", b"moron", b"trash", b"w"):
        having = sum(term in toxicity.terms((t or "").encode()) for _, t, *_ in data)
        assert np.isclose(model.idf[model.vocabulary[term]], 1 + np.log((1 + len(data)) / (1 + having)))


def test_neighbours_over_all_terms_are_exact(spark):
    rng = np.random.default_rng(5)
    at = [np.sort(rng.choice(900, rng.integers(1, 60), replace=False, p=(w := 1 / (1 + np.arange(900))) / w.sum())) for _ in range(1000)]
    weights = [(w := rng.random(len(a))) / np.sqrt((w**2).sum()) for a in at]
    lists = toxicity.Lists(np.arange(1000) // 2, at, weights, 900)  # some ids repeat
    assert 0 < lists.near.shape[0] < 900
    dense = np.zeros((1000, 900))
    for i, (a, w) in enumerate(zip(at, weights, strict=True)):
        dense[i, a] = w
    found = lists.nearest(list(zip(at, weights, strict=True))[:100], [i // 2 for i in range(100)], 9)
    for i, (best, values) in enumerate(found):
        sims = np.where(np.arange(1000) // 2 == i // 2, -1, dense @ dense[i])
        want = np.sort(sims)[::-1][:9]
        assert np.allclose(values, want[want > 0]) and np.allclose(sims[best], values)


def test_toxicity_of_awkward_rows(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(cases.rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert toxicity.toxicity(cases.empty(spark), labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_isotonic_steps_rise():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 0, 1]))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()


# licences


def test_licences_are_found_and_confirmed(spark):
    rng = random.Random(12)
    planted = {1: "Licensed under the Apache License, Version 2.0.", 2: "released under the MIT license", 3: "* This work is licensed under the GNU General Public License, version 3.", 4: "Licensed under CC BY-NC 4.0."}
    family = {1: "apache-2.0", 2: "mit", 3: "gpl", 4: "cc-by-nc"}
    data = [(i, "\n".join([cases.prose(rng, 20), *([planted[i % 5]] if i % 5 else []), "the license of the version and of this work", cases.prose(rng, 9)]), "en", "s") for i in range(200)]
    rows = licences.licences(cases.documents(spark, data)).where("confirmed").collect()
    assert {(r["doc_id"], r["family"]) for r in rows} == {(i, family[i % 5]) for i in range(200) if i % 5}
    assert all(r["first_line"] == r["last_line"] == 1 and r["probability"] > 0.5 for r in rows)


@pytest.fixture(scope="module")
def scanner():
    rng = random.Random(21)
    return licences.Scanner(licences.train([cases.prose(rng, 20).encode() for _ in range(300)] + [b"the license of the version and of this work"]))


@pytest.mark.parametrize("n", [30, 100, 1000, 10_000, 70_000])
def test_notices_inside_long_lines_are_found(scanner, n):
    rng, families = random.Random(n), list(licences.TEMPLATES)
    for family in families if n < 5000 else families[:4]:
        for template in licences.TEMPLATES[family]:
            before = rng.randrange(n)
            line = f"{cases.prose(rng, before)} {template} {cases.prose(rng, n - before)}"
            found = licences.findings(f"first line\n{line}\nlast line".encode(), scanner)
            assert [(a, b, families[f]) for a, b, f, _, s in found if s >= licences.LEAST_SHARED] == [(1, 1, family)], template


def test_several_families_on_one_line(scanner):
    rng, families = random.Random(5), list(licences.TEMPLATES)
    for gap in (0, 3, 60, 500):
        line = f"{cases.prose(rng, 40)} All rights reserved. {cases.prose(rng, gap)} Licensed under CC BY-SA 4.0. {cases.prose(rng, gap)} Released under the MIT License."
        found = licences.findings(line.encode(), scanner)
        assert {families[f] for *_, f, _, s in found if s >= licences.LEAST_SHARED} == {"reserved", "cc-by-sa", "mit"}
    apart = f"released under the {cases.prose(rng, 100)} MIT {cases.prose(rng, 100)} license rights reserved\nall"
    assert not [f for f in licences.findings(apart.encode(), scanner) if f[4] >= licences.LEAST_SHARED]


def test_licences_of_awkward_rows(spark):
    model = licences.fit(cases.documents(spark))
    assert licences.licences(cases.documents(spark), model).count() == 0
    assert licences.licences(cases.empty(spark)).count() == 0
    text = "\n".join(licences.TEMPLATES["mit"])
    assert licences.findings(text.encode(), model) and licences.findings(text.encode(), model)[0][2] == 1


def test_word_hash_cache_is_bounded():
    hashes = WordHashes()
    for i in range(3):
        hashes.of([f"{i}-{j}".encode() for j in range(300_000)])
    assert len(hashes) <= 700_000
