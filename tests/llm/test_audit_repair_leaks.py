import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import decontamination, filter_audit, turn_repair
from tests.llm import cases

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# ---- filter audit


def masks(data):
    least = {}
    for d, text, *_ in data:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    for d, text, lang, _ in data:
        raw = (text or "").encode()
        words = WORD.findall(raw)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text or "")) > 3 * len(text or ""),
            "D": bool(re.search(r"[#$%&*|]", text or "")),
            "E": d is not None and least[text or ""] < d,
        }
        yield d, lang or "", {f for f, bad in fails.items() if bad}


def brute_audit(data, labelled):
    good = {d for d, q, _ in labelled if q == 1 and d is not None}
    toxic = {d for d, _, t in labelled if t == 1 and d is not None}
    docs = list(masks(data))
    out = {}
    for part in {p for _, p, _ in docs}:
        mine = [(d, m) for d, p, m in docs if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                failing = sum(f in m for _, m in mine)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    failing - len(gone),
                    sum(m == {f} for _, m in mine),
                    sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone),
                    f,
                ]
        for key in [k for k in out if k[0] == part]:
            out[key][6] = shapley[out[key][6]]
    return out


AUDIT = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("leaf_bytes", [filter_audit.LEAF_BYTES, 300])
def test_filter_audit_equals_plain_code(spark, leaf_bytes):
    data = cases.rows()
    labelled = [tuple(r) for r in cases.labels(spark).collect()] + [(0, None, 1), (0, 1, None), (None, 1, 1)]
    got = filter_audit.audit(cases.documents(spark), spark.createDataFrame(labelled, cases.LABELS), leaf_bytes)
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in AUDIT] for r in got.collect()} == brute_audit(data, labelled)


def test_filter_audit_of_no_rows_and_of_copies_only(spark):
    assert filter_audit.audit(cases.empty(spark), cases.labels(spark)).count() == 0
    data = [(i % 50, "same text " * 400, None, "s") for i in range(400)] + [(None, "same text " * 400, None, "s")]
    got = filter_audit.failure_counts(cases.documents(spark, data), cases.labels(spark, []), 1000)
    # the least doc_id is held by 8 rows; they and the row without doc_id do not fail E
    assert {(r["mask"], r["rows"]) for r in got.groupBy("mask").agg(F.sum("rows").alias("rows")).collect()} == {(2, 9), (18, 392)}


def test_prefixes_grow_until_leaves_are_small(spark):
    texts = spark.createDataFrame([("shared beginning of all " + cases.prose(random.Random(i), 30),) for i in range(200)], "text string")
    keys = texts.withColumn("key", filter_audit.adaptive_prefix(texts, 2000)).groupBy("key").agg(F.sum(F.octet_length("text")).alias("n"))
    assert max(r["n"] for r in keys.collect()) <= 2000
    assert texts.select(filter_audit.adaptive_prefix(texts, 1 << 30).alias("k")).distinct().count() == 1


def test_trie_holds_texts_apart():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(8))) for _ in range(500)]
    trie = filter_audit.Trie()
    for text in texts:
        groups = trie.terminal(text)
        groups[text] = groups.get(text, 0) + 1
    found = list(trie.terminals())
    assert all(len(groups) == 1 for groups in found)
    assert {k: n for groups in found for k, n in groups.items()} == {t: texts.count(t) for t in texts}


# ---- conversation repair


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        def show(x):
            return " " if x is None else str(x)

        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """Plain Wagner-Fischer against every target, no band."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        inner = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not inner else "d" if (role, text) in seen else "" if inner[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    n, best = len(rows), None
    for head in ("", "s"):
        for pairs in range(1 if head else 0, n + 2):
            target = head + "ua" * pairs

            @functools.lru_cache(None)
            def align(i, j):
                if i == n and j == len(target):
                    return 0, ""
                ways = []

                def add(cost, letter, rest):
                    if rest is not None:
                        ways.append((cost + rest[0], letter + rest[1]))

                if i < n:
                    add(4, "D", align(i + 1, j))
                if j < len(target) and target[j] != "s":
                    add(3, "I", align(i, j + 1))
                if i < n and j < len(target) and faults[i] in ("", "t"):
                    extra = 3 if faults[i] else 0
                    if initials[i] == target[j]:
                        add(extra, "K", align(i + 1, j + 1))
                    if target[j] != "s":
                        add(3 + extra, "R", align(i + 1, j + 1))
                return min(ways, default=None)

            way = align(0, 0)
            if way is not None and (best is None or (*way, target) < best):
                best = (*way, target)
    cost, audit, target = best
    lines, i, j = [], 0, 0
    for edit in audit:
        name = {"u": "user", "a": "assistant", "s": "system", "": ""}[target[j : j + 1]]
        if edit == "I":
            lines.append(f"{name}:")
        elif edit != "D":
            lines.append(f"{rows[i][2] if edit == 'K' else name}:{rows[i][3]}")
        i, j = i + (edit != "I"), j + (edit != "D")
    turns = {r[1] for r in rows} - {None}
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)


def conversations():
    rng = random.Random(11)
    texts = ["Fine.", "no end", "", " ", None, "Yes!", "Yes!", "x? ", "a.b", "Well. "]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
    out = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            out.append((conv, turn + (turn > 3) * 2, ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(roles), rng.choice(texts)))
    out += [(100, i % 5 if i % 7 else None, rng.choice(roles), rng.choice(texts) if i % 3 else f"t{i}.") for i in range(14)]
    out += [(None, i, "user", f"{i}!") for i in range(4)] + [(None, None, None, None)]
    dropped = [c for c in range(1000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    out += [(c, 0, "user", "Gone.") for c in dropped]
    return out


SHAPE = "conv_id long, turn long, role string, text string, copies string, slice int, n int"
FACTS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def repaired(spark, data, **options):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in data], SHAPE).repartition(3)
    return {r["conv_id"]: tuple(r[f] for f in FACTS) for r in turn_repair.repaired(turn_repair.damaged(table), **options).collect()}


@pytest.mark.parametrize("options", [{}, {"short": 3}, {"short_bytes": 20}])
def test_repair_equals_plain_code(spark, monkeypatch, options):
    monkeypatch.setattr(turn_repair, "SLICE", 4)
    data = conversations()
    after = damage(data)
    want = {c: brute_repair([r for r in after if r[0] == c]) for c in {r[0] for r in data}}
    assert repaired(spark, data, **options) == want
    assert any(w[6] == "" for w in want.values()) and len({len(w[6]) for w in want.values()}) > 5


def test_repair_of_no_rows_and_one_long_conversation(spark, monkeypatch):
    assert repaired(spark, []) == {}
    monkeypatch.setattr(turn_repair, "SLICE", 64)
    rng = random.Random(2)
    data = [(7, i, ("user", "assistant")[i % 2] if rng.random() < 0.9 else "system", f"{rng.randrange(900)}.") for i in range(1500)]
    assert repaired(spark, data) == repaired(spark, data, short=10_000)


def test_no_slice_depends_on_the_band():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(1, 8)
        rows = [(0, i, rng.choice(["user", "assistant", "system", "x", ""]), rng.choice(["A.", "b", "", f"{i}."])) for i in range(n)]
        got = turn_repair._repair([{"turn": r[1], "role": r[2], "text": r[3], "copies": 1} for r in rows])
        want = brute_repair(rows)
        assert (got[5], got[6], got[7]) == want[5:]


# ---- decontamination


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute_leaks(data, items, size=10):
    windows = []
    for item, text in items:
        words = plain_words(text)
        n = min(size, len(words))
        windows += [(item, words[i : i + n]) for i in range(len(words) - n + 1) if n]
    out = []
    for d, text in data:
        words, hit, met = plain_words(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    met |= {str(item)} - {"None"}
        listed = ",".join(sorted(met)).encode()
        out.append((d, len(words), len(hit), len(met), hashlib.sha256(listed).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LEAKS = "doc_id n_words n_hit n_items items_sha256 contaminated".split()


def leak_tables():
    rng = random.Random(8)
    items = [(i, cases.prose(rng, n, 40)) for i, n in enumerate((10, 11, 25, 60, 9, 5, 3, 1, 40, 30))]
    items += [(20, None), (21, ""), (22, "-- !"), (None, cases.prose(rng, 15, 4000)), (3, cases.prose(rng, 12, 4000)), (30, items[2][1]), (31, "É ß 漢字")]
    data = [(d, t) for d, t, *_ in cases.rows()]
    for i, (_, text) in enumerate(items):
        words = (text or "").split()
        data.append((800 + i, f"{cases.prose(rng, 7)} {' '.join(words).upper()}, {cases.prose(rng, 4)}"))
        data.append((900 + i, "; ".join(words[1:])))
        data.append((900 + i, f"{' '.join(words[: len(words) // 2])} - {' '.join(words[-11:])}"))
    data += [(2000, " ".join(["w1"] * 300)), (2001, items[3][1] + " " + items[3][1])]
    return data, items


@pytest.mark.parametrize("size,gram", [(10, 5), (10, 10), (6, 2)])
def test_leaks_equal_plain_code(spark, size, gram):
    data, items = leak_tables()
    docs = cases.documents(spark, [(d, t, "en", "s") for d, t in data])
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, doc_id string, print int").repartition(2)
    got = decontamination.digests(docs, bench, size, gram)
    want = brute_leaks(data, items, size)
    assert cases.found(got, *LEAKS) == want and sum(r[5] for r in want) > 20
    hits = {r["doc_id"]: (r["n_hit"], r["hits"]) for r in decontamination.contamination(docs, bench, size, gram).where("doc_id > 2000").collect()}
    assert all(n == sum(end - start for start, end in spans) for n, spans in hits.values())
    clean = {r["doc_id"] for r in decontamination.clean_documents(docs, bench, size, gram).collect()}
    assert clean == {r[0] for r in want if not r[5]}


def test_leaks_of_empty_tables(spark):
    data, items = leak_tables()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.digests(cases.empty(spark), bench).count() == 0
    none = decontamination.digests(cases.documents(spark, [(1, "a b", "en", "s")]), bench.limit(0)).collect()
    assert [tuple(r) for r in none] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_long_item_fingerprints_by_shuffle(spark, monkeypatch):
    from lodestrata.llm import small

    monkeypatch.setattr(small.joined, "__defaults__", (0,))
    data, items = leak_tables()
    docs = cases.documents(spark, [(d, t, "en", "s") for d, t in data])
    got = decontamination.digests(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert cases.found(got, *LEAKS) == brute_leaks(data, items)


def test_winnowing_keeps_one_hash_of_every_run():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (0, 3, 6, 200):
        grams = rng.integers(0, 20, n).astype(np.uint64)
        at = decontamination.winnowed(grams, 6)
        assert all(((at >= i) & (at < i + 6)).any() for i in range(n - 5))
        want = sorted({max(range(i, i + 6), key=lambda j: (-int(grams[j]), j)) for i in range(n - 5)})
        assert at.tolist() == want
