"""Small tables with every awkward case, shared by the tests of this folder."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        *(T.StructField(n, T.StringType()) for n in ("size", "taken", "tag", "pos", "component", "node", "n", "ids", "score", "_md5", "word")),
    ]
)
LABELS = "doc_id long, quality int, toxic int"
OTHER = ("x",) * 11


def prose(rng, n, words=300):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def rows(seed=3):
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(40)]
    passage = prose(rng, 30, 5000)
    out = [(i, t, "en", f"src{i % 4}") for i, t in enumerate(base)]
    out += [(100 + i, base[3], "en", "src0") for i in range(12)]  # exact copies
    long = prose(rng, 150, 9000)
    for i in range(12):  # near copies
        words = long.split()
        words[rng.randrange(150)] = f"edit{i}"
        out.append((200 + i, " ".join(words), "de", "src1"))
    out += [(300 + i, f"{prose(rng, 25)}\n{passage}\n{prose(rng, 25)}", "fr", None) for i in range(6)]
    out += [(400, None, None, None), (401, "", "en", "src2"), (402, " \t\n\x0b", "en", "src2"), (403, "one", "en", "src2"), (404, "One", "en", "z")]
    out += [(405, "two words", "en", "src2"), (406, "two words", "en", "src2"), (407, "Two  words", "en", None)]
    out += [(None, prose(rng, 40), "en", "src3"), (None, None, "en", "src3"), (None, prose(rng, 40), None, None)]
    out += [(500, base[5], "en", "src1")] * 3 + [(500, prose(rng, 30), "en", "src1")]  # repeated rows, a repeated doc_id
    out += [(600, prose(rng, 20_000, 50), "en", "src0"), (601, "x" * 3000 + " " + "1" * 500 + "." + "@" * 200 + "+" * 200, "en", "src0")]
    out += [(700, "line a b\nline a b\n" * 30, "en", "src0"), (701, "é ü 漢字 ß x  y \x1c z", "en", "src0"), (702, "a # $ | <b>", "es", "src3")]
    return out


def documents(spark, data=None):
    data = rows() if data is None else data
    full = [(d, t, lang, source, None if t is None else len(t), *OTHER) for d, t, lang, source in data]
    return spark.createDataFrame(full, DOCS).repartition(3)


def labels(spark, data=None):
    data = rows() if data is None else data
    known = [(d, None if d is not None and d % 7 == 0 else int(d is not None and d % 3 > 0), int(d is not None and d % 5 == 0)) for d, *_ in data]
    return spark.createDataFrame([*known, (9999, 1, 1), (None, 1, 0)], LABELS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def found(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
