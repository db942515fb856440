import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lodestrata.llm import components, jaccard, mixing, pii, substring
from lodestrata.llm.words import WordHashes
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


# mixing


def mix_plainly(data, share=1.5, epochs=2):
    sizes = defaultdict(int)
    for _, text, _, source in data:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full: set = set()
    while True:
        open_ = [s for s in order if s not in full]
        level = (share * sum(sizes.values()) - epochs * sum(sizes[s] for s in full)) / max(sum(weight[s] for s in open_), 1)
        more = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not more:
            break
        full |= more
    target = {s: epochs * float(sizes[s]) if s in full else level * weight[s] for s in order}
    out = []
    for s in order:
        own = [(hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest(), len(words(t)), "" if t is None else hashlib.md5(t.encode()).hexdigest(), d) for d, t, _, x in data if x == s]
        before, budget = 0, int(target[s])
        for _, n, _, d in sorted(own, key=lambda x: x[:3]):
            passes = budget // sizes[s] if sizes[s] else 0
            out.append((d, n, sizes[s], round(target[s], 6), passes * n + max(0, min(n, budget - passes * sizes[s] - before))))
            before += n
    return sorted(out, key=repr)


def test_mix_matches_plain_code_and_reruns_agree(spark):
    docs = cases.documents(spark)
    runs = [[(d, n, s, round(t, 6), k) for d, n, s, t, k in cases.found(mixing.mix(docs), "doc_id", "size", "source_size", "target", "taken")] for _ in range(2)]
    assert sorted(runs[0], key=repr) == sorted(runs[1], key=repr) == mix_plainly(cases.rows())


def test_mixed_documents_hold_the_words_taken(spark):
    docs = cases.documents(spark)
    taken = sum(r["taken"] for r in mixing.mix(docs).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sum(len(words(r["text"])) for r in mixed.collect()) == taken
    texts = {r["text"] for r in docs.collect()}
    assert sum(r["text"] not in texts for r in mixed.collect()) <= 5  # at most one cut document a source


@pytest.mark.parametrize("function", [mixing.mix, mixing.mixed_documents])
def test_mix_of_nothing(spark, function):
    assert function(cases.empty(spark)).count() == 0
    blank = cases.documents(spark, [(1, None, None, None), (2, "", "en", "a")])
    assert sum(r["taken"] for r in mixing.mix(blank).collect()) == 0


# Jaccard join


def shingle_set(text, n):
    w = words((text or "").translate(UPPER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components_plainly(data, like):
    sets = [shingle_set(t, like.words) for _, t, *_ in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and like.per * len(a & sets[j]) >= like.share * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, *_) in enumerate(data):
        ids[find(i)].append(d)
    out = []
    for i, (d, *_) in enumerate(data):
        known = [x for x in ids[find(i)] if x is not None]
        out.append((d, len(sets[i]), (min(known) if known else None) if sets[i] else d))
    return sorted(out, key=repr)


@pytest.mark.parametrize("like", [jaccard.Similarity(3, 90), jaccard.Similarity(5, 80), jaccard.Similarity(1, 60)])
def test_components_match_brute_force(spark, like):
    got = cases.found(jaccard.jaccard_components(cases.documents(spark), like), "doc_id", "n_shingles", "component_id")
    assert got == components_plainly(cases.rows(), like)


def test_components_of_random_near_copies(spark):
    """Chains of small edits: links at and around the threshold, groups that touch."""
    rng = random.Random(8)
    data = []
    for g in range(6):
        text = [f"g{g}x{rng.randrange(400)}" for _ in range(60)]
        for i in range(25):
            text = list(text)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                text[rng.randrange(60)] = f"e{g}y{rng.randrange(40)}"
            data.append((g * 100 + i, " ".join(text), "en", "s"))
    for like in (jaccard.Similarity(1, 90), jaccard.Similarity(2, 80)):
        got = cases.found(jaccard.jaccard_components(cases.documents(spark, data), like), "doc_id", "n_shingles", "component_id")
        assert got == components_plainly(data, like)


def test_components_of_nothing(spark):
    assert jaccard.jaccard_components(cases.empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    like = jaccard.Similarity(5, 80)
    kept = jaccard.distinct_documents(cases.documents(spark), like)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = cases.found(jaccard.jaccard_components(kept, like), "doc_id", "n_shingles", "component_id")
    groups = {(r[2], r[0]) for r in components_plainly(cases.rows(), like) if r[1]}
    full = [r for r in got if r[1]]
    assert len({r[2] for r in full if r[2] is not None}) == len({c for c, _ in groups if c is not None})
    assert all(r[0] == r[2] for r in full)
    assert len([r for r in got if not r[1]]) == sum(not words(t) for _, t, *_ in cases.rows())


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(80)] + [(500, 500 + i) for i in range(1, 40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    got = {tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).select("node", "component").collect()}
    assert got == {(x, find(x)) for x in root if x not in alone}


def test_profiles_bound_the_overlap():
    rng = np.random.default_rng(9)
    for n in (1, 40, 5000, 60_000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, n - n // 2).astype(np.uint64)]))
        bound = jaccard.most_common(jaccard.profile(a), jaccard.profile(b))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))
        assert jaccard.most_common(jaccard.profile(a), jaccard.profile(a)) == len(a)
    a, b = (np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64)) for _ in range(2))
    assert jaccard.most_common(jaccard.profile(a), jaccard.profile(b)) < 850  # a link by 90 % needs 947
    assert jaccard.profile(np.zeros(0, np.uint64)) == bytes(jaccard.PROFILE_BUCKETS)


def test_hashes_of_words_stay_equal_when_the_cache_is_emptied():
    names = [b"w%d" % i for i in range(60_000)]
    hashes = WordHashes()
    first = hashes.of(names)
    assert hashes.of(names[:3]).tolist() == first[:3].tolist() and len(hashes) == 3


def test_near_copies_are_led_by_one_of_them_though_others_share_bands(spark):
    """Smaller nodes that share four of six bands with a group of near copies, but not each other's rest, lead none of it."""
    others = [(i, [1, 2, 3, 4, 1000 + 2 * i, 1001 + 2 * i]) for i in range(20)]
    copies = [(100 + i, [1, 2, 3, 4, 5, 6] if i else [1, 2, 3, 4, 5, 7]) for i in range(12)]
    nodes = spark.createDataFrame(others + copies, "node long, bands array<long>")
    heads = {r["node"]: r["head"] for r in jaccard._heads(nodes).collect()}
    assert all(heads[node] == 101 for node, _ in copies if node != 101)
    assert {heads[node] for node, _ in others} == {101} and 101 not in heads


# substring dedup


def repeats_plainly(data):
    first = {}
    order = lambda d: (d is None, d or 0)
    for d, text, *_ in data:
        w = words(text)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            first[key] = min(first.get(key, ((True, 1 << 62), 0)), (order(d), i))
    out = []
    for d, text, *_ in data:
        w = words(text)
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (order(d), i):
                gone.update(range(i, i + 20))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def test_repeats_match_brute_force(spark):
    got = cases.found(substring.without_repeats(cases.documents(spark)), "doc_id", "n_words", "n_removed", "kept")
    assert got == repeats_plainly(cases.rows())


def test_repeats_across_factor_boundaries(spark):
    """Texts stitched from pieces of others, so that factors end inside repetitions of third texts."""
    rng = random.Random(2)
    pool = [f"p{i}" for i in range(400)]
    data = [(0, " ".join(pool), "en", "s")]
    for i in range(1, 40):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            a = rng.randrange(380)
            parts += pool[a : a + rng.randrange(5, 45)]
            if rng.random() < 0.4:
                parts += [f"n{rng.randrange(30)}" for _ in range(rng.randrange(3))]
        data.append((i, " ".join(parts), "en", "s"))
        pool = parts + pool[: 400 - len(parts)] if rng.random() < 0.2 and len(parts) < 300 else pool
    data += [(90, "a " * 100, "en", "s"), (91, "b c " * 60, "en", "s"), (92, "a " * 30, "en", "s")]
    got = cases.found(substring.without_repeats(cases.documents(spark, data)), "doc_id", "n_words", "n_removed", "kept")
    assert got == repeats_plainly(data)


def test_repeats_beyond_the_broadcast_bound_are_the_same(spark, monkeypatch):
    monkeypatch.setattr(substring, "BROADCAST_BYTES", 0)
    got = cases.found(substring.without_repeats(cases.documents(spark)), "doc_id", "n_words", "n_removed", "kept")
    assert got == repeats_plainly(cases.rows())
    assert substring.without_repeats(cases.empty(spark)).count() == 0


def test_repeated_rows_gather_the_anchors_of_one_text(spark):
    rng = random.Random(17)
    text = cases.prose(rng, 200, 5000)
    docs = cases.documents(spark, [(i, t, "en", "s") for i, t in [*[(None, text)] * 80, *[(7, text)] * 80]])
    index = substring._index(docs).cache()
    one = index.where("doc = 7").distinct().count()
    pointers = substring._pointers(index).cache()
    assert [len(r["found"]) for r in pointers.collect()] == [one]  # the earliest places point nowhere
    checked = substring._checked(pointers.selectExpr("doc", "tag", "binary('') AS factors", "found AS open"))
    windows = substring._open_windows(docs, checked)
    assert [len(r["starts"]) for r in substring.duplicate_windows(windows).collect()] == [200 - substring.WINDOW + 1]


def test_only_boundaries_are_hashed(spark):
    rng = random.Random(23)
    shared = cases.prose(rng, 2000, 9000)
    docs = cases.documents(spark, [(i, f"{cases.prose(rng, 100, 9000)} {shared} {cases.prose(rng, 100, 9000)}", "en", "s") for i in range(4)])
    parsed = substring._parsed(substring._pointers(substring._index(docs)))
    windows = substring._open_windows(docs, substring._checked(parsed)).groupBy("doc").count().collect()
    # in the first document, where all is earliest, only what its copies leave open is hashed
    assert all(r["count"] < 200 for r in windows) and len(windows) == 4


# personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_plainly(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),  # noqa: B023
                "card": lambda: 12 <= len(digits) <= 19 and pii.luhn(digits),  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return pii.ordered(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(4)
    alphabet = ["1", "23", "255", "256", ".", "@", "a", "B-", "+", "%", " ", "(", ")", "-", "4929348385146306", "é", "\n", "x.y", "0"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25)))
        assert pii.base_spans(text) == base_plainly(text), text
    assert pii.luhn("4929348385146306") and not pii.luhn("4929348385146307")


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 200_000, "@" * 200_000, "1." * 100_000, "+" * 200_000, "a@" * 100_000):
        pii.base_spans(text)
        pii.stretches(text)


def personal(n=400):
    rng = random.Random(6)
    out = []
    for i in range(n):
        item = rng.choice(
            [
                f"{rng.choice(['ann', 'bob.k', 'z9'])}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
                f"{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}",
                f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
                "4929348385146306",
                f"version {rng.randrange(9)}.{rng.randrange(9)}",
                f"{rng.randrange(10_000)} items",
            ]
        )
        out.append((i, f"{cases.prose(rng, 8)} {item} {cases.prose(rng, 5)}.", "en", "s"))
    return out


def test_field_keeps_the_base_and_adds_variants(spark):
    data = personal()
    hidden = [(900, "call 1 (640) 555-0953 now", "en", "s"), (901, "mail bob.k.7[at]mail3.example.com today", "en", "s"), (902, "version 3.1 of 20 items", "en", "s")]
    rows = {r["doc_id"]: r for r in pii.personal_data(cases.documents(spark, data + hidden)).collect()}
    for d, text, *_ in data:
        base = base_plainly(text)
        assert rows[d]["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(pii.written(base).split(",")) <= set(rows[d]["spans"].split(","))
        assert rows[d]["n_phone"] == sum(k == "phone" for k, *_ in base)
    assert rows[900]["spans"] == "phone:5:21" and rows[900]["n_phone"] == 0 and rows[900]["n_added"] == 1
    assert rows[901]["spans"] == "email:5:33" and rows[902]["spans"] == ""


FORMS = [
    ("write to {} please", "john [at] example.com", "email"), ("mail {} now", "mary.k[AT]mail.example.org", "email"), ("see {} or call", "bob{at}site.example.com", "email"),
    ("reach {} soon", "ann at example dot com", "email"), ("from {} today", "jo.li(at)some.example.net", "email"), ("ask {} there", "kim (at) example.com", "email"),
    ("call {} today", "0049 30 1234567", "phone"), ("dial {} please", "001 (640) 555-0953", "phone"), ("ring {} at noon", "0170 4567890", "phone"),
    ("number {} works", "1 (640) 555-0953", "phone"),
]
ALIKE = ["meet [at] noon there", "the dot com years", "look at the dot above", "version 3.1 of 20 items", "the year 2024 and 12 months", "(at) home [dot]", "dot", "at dot at"]


def test_field_finds_written_forms_and_leaves_the_like_alone():
    examples = []
    for _, text, *_ in personal():
        text = re.sub(r"\bw(\d+)", lambda m: "w" + "".join(chr(97 + int(c)) for c in m[1]), text)  # words of letters
        for s in pii.stretches(text):
            near = [x for x in pii.base_spans(text) if x[1] < s.places[-1][1] and s.places[0][0] < x[2]]
            examples += pii.variants(pii.Stretch([(0, 0)] * len(s.words), s.words, s.before, s.after), pii.word_labels(s, near))
    field = pii.train(examples)
    texts = [frame.format(item) for frame, item, _ in FORMS]
    found = [[(k, t[a:b]) for k, a, b in spans] for t, (_, spans) in zip(texts, pii.all_spans(texts, field))]
    hits = sum((kind, item) in spans for spans, (_, item, kind) in zip(found, FORMS))
    assert hits >= 0.9 * len(FORMS), found
    assert [spans for _, spans in pii.all_spans(ALIKE, field)] == [[]] * len(ALIKE)
    assert pii.all_spans(["x " * 500 + "[at] " * 300 + "dot " * 300], field)[0][0] == []


def test_viterbi_matches_all_paths():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    field = pii.Field({}, np.zeros((0, 9)), rng.normal(size=(9, 9)))
    scores = [rng.normal(size=(n, 9)) for n in (1, 2, 3, 4, 2)]
    for s, labels in zip(scores, field._viterbi(scores), strict=True):
        value = lambda p, s=s: sum(s[t, y] for t, y in enumerate(p)) + sum(field.step[a, b] for a, b in itertools.pairwise(p))
        best = max(itertools.product(range(9), repeat=len(s)), key=value)
        assert tuple(labels) == best


def test_personal_data_of_awkward_rows(spark):
    docs = cases.documents(spark)
    got = pii.personal_data(docs)
    assert cases.found(got, "doc_id", "base_sha256") == sorted(((d, hashlib.sha256(pii.written(base_plainly(t or "")).encode()).hexdigest()) for d, t, *_ in cases.rows()), key=repr)
    assert pii.personal_data(cases.empty(spark)).count() == 0
    clean = pii.redacted_documents(cases.documents(spark, personal(60)))
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(not base_plainly(r["text"]) and r["n_chars"] == len(r["text"]) for r in clean.collect())
    assert pii.redacted_documents(docs).where("text IS NULL").count() == sum(t is None for _, t, *_ in cases.rows())
