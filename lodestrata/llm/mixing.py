"""Mixing sources to target weights.

Sources share ``share`` times all words by weight. A source gives at most ``epochs`` times its own
words; what it cannot give goes to the others, again by weight. Inside a source documents stand in
the order of ``md5(seed:doc_id)``, a distributed prefix sum of their words is taken, and the order is
cut exactly where the target is reached: whole passes first, then the part of one more pass. The one
document at the cut gives some of its words.

Defined results: null or empty texts have size 0 and are taken 0 times; a null source is a source of
its own, last in order; a source without words has target 0. Repeated rows (same source, doc_id and
text) count as copies of one unit, which are taken one after the other. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.small import joined
from lodestrata.llm.spread import prefix_sums
from lodestrata.sources.workspace import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
COPIES_PER_ROW = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def units(docs: DataFrame) -> DataFrame:
    """``source, doc_id, text_md5, size, copies``: one row per distinct document."""
    return (
        docs.select("source", "doc_id", F.md5("text").alias("text_md5"), word_count(F.col("text")).alias("size"))
        .groupBy("source", "doc_id", "text_md5", "size")
        .agg(F.count("*").alias("copies"))
    )


def targets(units: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """``source, source_size, target`` per source. Only sums reach the driver, however many sources."""
    sizes = materialise(units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), "sources")
    one = sizes.withColumn("_all", F.lit(1)).withColumn("_one", F.lit(1))
    ranked = prefix_sums(one, "_all", [F.col("source").asc_nulls_last()], "_one", sizes.count())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "weights")
    cap, level, full = F.col("source_size") * F.lit(float(epochs)), None, F.lit(False)
    while True:  # each round caps more sources; few rounds, each one aggregate
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("capped"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            break
        last, level = level, (share * row["all"] - float(epochs) * row["capped"]) / row["weight"]
        if level == last:
            break
        full = F.col("weight") * F.lit(level) > cap
    share_of = F.when(full, cap).otherwise(F.col("weight") * F.lit(level or 0.0))
    return ranked.select("source", "source_size", share_of.cast("double").alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, epochs: int = 2, seed: str = "mix"
) -> DataFrame:
    """``source, doc_id, text_md5, copy, size, source_size, target, taken`` per row of ``docs``."""
    found = materialise(
        units(docs).withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))),
        "units",
    )
    goals = targets(found, weights, share, epochs).withColumnRenamed("source", "_source")
    weighed = found.withColumn("words", F.col("size") * F.col("copies"))
    placed = prefix_sums(weighed, "source", [F.col("key"), F.col("size"), F.col("text_md5")], "words", found.count())
    placed = placed.join(goals, F.col("source").eqNullSafe(F.col("_source")))
    budget = F.floor("target")
    passes = F.expr("CASE WHEN source_size > 0 THEN floor(target) DIV source_size ELSE 0 END")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_PER_ROW).cast("long")))
    within = F.explode(F.sequence(F.col("_block"), F.least(F.col("_block") + COPIES_PER_ROW, F.col("copies")) - 1))
    rest = budget - passes * F.col("source_size") - F.col("before") - F.col("copy") * F.col("size")
    return (
        placed.withColumn("_block", blocks)
        .withColumn("copy", within)
        .withColumn("taken", passes * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least("size", rest)))
        .select("source", "doc_id", "text_md5", "copy", "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: one row per whole pass over a document, and of the document at the cut of a
    source a row with the words taken of it, joined by blanks. Columns are those of ``documents``."""
    own = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("_md5", F.md5("text"))
    taken = mix(docs, **options)
    plan = materialise(
        taken.groupBy(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("text_md5").alias("_m"))
        .agg(F.sum("taken").alias("_words"), F.first("size").alias("_size"), F.count("*").alias("_copies"))
        .where("_words > 0"),
        "plan",
    )
    if plan.where("_copies > 1").limit(1).count():  # the plan counts a unit's copies together
        own = own.dropDuplicates(["source", "doc_id", "_md5"])
    same = F.col("source").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_md5") == F.col("_m"))
    rest = F.col("_words") % F.col("_size")
    passes = F.expr("_words DIV _size")
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, rest.cast("int")), " ")
    parts = F.concat(
        F.transform(F.sequence(F.lit(0).cast("long"), passes), lambda i: F.when(i < passes, F.lit(True))),
        F.array(F.when(rest > 0, F.lit(False))),
    )
    return (
        joined(own, plan, same, "inner", 128)
        .withColumn("_whole", F.explode(F.filter(parts, lambda p: p.isNotNull())))
        .withColumn("text", F.when(F.col("_whole"), F.col("text")).otherwise(part))
        .withColumn("n_chars", F.when(F.col("_whole"), F.col("n_chars")).otherwise(F.length("text").cast("long")))
        .select("doc_id", "text", "lang", "source", "n_chars")
    )
