"""K-d tree partitioning into shards of nearly equal bytes, with DataFrame operations only.

Every node of the tree is split at the weighted median of its widest metadata dimension, until leaves
reach the target bytes. All nodes of one depth are split together. The median is found exactly by
descending through digits of the order key: one aggregate per digit gives the bytes per node and
digit value, and the half falls into one of them. No rows are sorted and no row leaves its place.

The order key is the dimension, then CRC and hash of the text, then a hash of ``doc_id``, then a copy number. Dimensions are
those of a text: its bytes, and of its copies the first source and the first language by name (the
first ``NAME_BYTES`` bytes of a name count as a number). So copies of a text lie next to each other and share a shard save where one of
the cuts falls inside their group. Rows that repeat one doc_id and text are numbered - per task first, then by the tasks' counts -
so a group of them that holds a third of all bytes is cut like any other.

Law ``bytes``: each cut is off by less than one row. Slots count the rows of a shard from 0.

Defined results: a null text has size 1, CRC 0 and counts as the empty text; a null dimension lies
below all values; equal rows are interchangeable. An empty
table gives no rows; with fewer rows than shards some shards stay empty. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.llm.small import joined
from lodestrata.sources.workspace import discard, materialise

DIGIT_BITS = 16
NAME_BYTES = 6
COPIES_PER_RANGE = 65_536
SPAN_BITS = 31
ROWS_PER_SLOT_RANGE = 100_000


def _digits(depth_bits: int) -> list[int]:
    """Shifts from the highest digit of a key of so many bits down to the lowest."""
    return list(range(-(-depth_bits // DIGIT_BITS) * DIGIT_BITS - DIGIT_BITS, -1, -DIGIT_BITS))


def _number_of(name: str) -> Column:
    """A name as a number that keeps its order, up to its first bytes."""
    digits = F.substring(F.hex(F.col(name).cast("binary")), 1, 2 * NAME_BYTES)
    return F.conv(F.rpad(digits, 2 * NAME_BYTES, "0"), 16, 10).cast("double")


def default_dimensions() -> dict[str, Column]:
    return {"bytes": F.col("size").cast("double"), "source": _number_of("source"), "lang": _number_of("lang")}


def _metadata(docs: DataFrame) -> DataFrame:
    """Narrow rows with hashes of text and id; copies of a text get one source and one language, the first by name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", text.alias("text")).select(
        "doc_id",
        "source",
        "lang",
        (F.octet_length("text").cast("long") + 1).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64("doc_id").alias("doc_hash"),
        F.monotonically_increasing_id().alias("at"),
    )
    base = materialise(base, "metadata")
    of_text = base.groupBy(F.col("text_hash").alias("_text")).agg(
        F.count("*").alias("_n"), *(f(c).alias(f"_{k}_{c}") for c in ("source", "lang") for k, f in (("min", F.min), ("max", F.max), ("n", F.count)))
    )
    differs = [(F.col(f"_min_{c}") != F.col(f"_max_{c}")) | ((F.col(f"_n_{c}") > 0) & (F.col(f"_n_{c}") < F.col("_n"))) for c in ("source", "lang")]
    mixed = materialise(of_text.where(differs[0] | differs[1]).select("_text", "_min_source", "_min_lang"), "mixed")
    named = joined(base, mixed, F.col("text_hash") == F.col("_text"), "left", 64)
    for c in ("source", "lang"):
        named = named.withColumn(c, F.when(F.col("_text").isNull(), F.col(c)).otherwise(F.col(f"_min_{c}")))
    return named.drop("_text", "_min_source", "_min_lang")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: the number of a row among those that repeat its doc_id and text, from 0."""
    unit = ["text_hash", "doc_hash"]
    several = rows.groupBy(*unit).agg(F.count("*").alias("n")).where("n > 1")
    several = materialise(several.select(F.col("text_hash").alias("_text"), F.col("doc_hash").alias("_doc")), "several")
    if several.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    same = (F.col("text_hash") == F.col("_text")) & (F.col("doc_hash") == F.col("_doc"))
    alone = joined(rows, several, same, "left_anti", 24).withColumn("copy", F.lit(0).cast("long"))
    repeated = joined(rows, several, same, "left_semi", 24).withColumn("_task", F.shiftrightunsigned("at", 33))
    counts = repeated.groupBy(*unit, "_task").agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(*unit).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*unit, "_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = repeated.withColumn("_row", F.row_number().over(W.partitionBy(*unit, "_task").orderBy("at")) - 1).join(offsets, [*unit, "_task"])
    return alone.unionByName(placed.withColumn("copy", (F.col("_before") + F.col("_row")).cast("long")).select(alone.columns))


def kd_shards(docs: DataFrame, shards: int = 16, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: leaves of at most ``target_bytes`` (off by less than a
    row), or of an equal part for each of ``shards``, a power of two."""
    dimensions = dimensions or default_dimensions()
    names = list(dimensions)
    rows = materialise(_metadata(docs), "metadata")
    table = _numbered(rows).select(
        "doc_id", "size", "text_crc32", "text_hash", "doc_hash", "copy", F.lit(0).alias("node"), *(dimensions[n].alias(f"dim_{n}") for n in names)
    )
    table = materialise(table, "shards")
    discard(rows)
    whole = [F.min(f"dim_{n}").alias(f"lo_{n}") for n in names] + [F.max(f"dim_{n}").alias(f"hi_{n}") for n in names]
    scale = table.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *whole).first()
    if target_bytes is None:
        target_bytes = -(-scale["bytes"] // shards)
    leaf = scale["bytes"]
    while leaf > max(1, target_bytes):  # every cut halves all nodes
        leaf = -(-leaf // 2)
        last, table = table, materialise(_split(table, names, scale), "shards")
        discard(last)
    return _slotted(table)


def _scaled(name: str, scale) -> Column:
    """A dimension over its whole range as an integer of ``SPAN_BITS`` bits; null lies lowest."""
    lo, hi = scale[f"lo_{name}"], scale[f"hi_{name}"]
    if lo is None or hi <= lo:
        return F.lit(0).cast("long")
    top = float((1 << SPAN_BITS) - 2)
    return F.coalesce(F.floor((F.col(f"dim_{name}") - lo) / (hi - lo) * top).cast("long") + 1, F.lit(0).cast("long"))


def _split(table: DataFrame, names: list[str], scale) -> DataFrame:
    """Children of every node: cut at the weighted median along the node's widest dimension."""
    scaled = {n: _scaled(n, scale) for n in names}
    spans = table.groupBy("node").agg(
        F.sum("size").alias("_bytes"),
        *((F.max(scaled[n]) - F.min(scaled[n])).alias(n) for n in names),
    )
    nodes = {r["node"]: r for r in spans.collect()}  # at most one row per shard
    if not nodes:
        return table
    widest = {n: max(names, key=lambda d: (r[d], -names.index(d))) for n, r in nodes.items()}
    value = F.lit(0).cast("long")
    for name in names:
        own = [n for n, d in widest.items() if d == name]
        if own:
            value = F.when(F.col("node").isin(own), scaled[name]).otherwise(value)
    order = [
        (F.shiftleft(value, 32).bitwiseOR(F.col("text_crc32")), _digits(63)),
        (F.shiftrightunsigned("text_hash", 32), _digits(32)),
        (F.col("text_hash").bitwiseAND(F.lit(0xFFFFFFFF)), _digits(32)),
        (F.shiftrightunsigned("doc_hash", 32), _digits(32)),
        (F.col("doc_hash").bitwiseAND(F.lit(0xFFFFFFFF)), _digits(32)),
        (F.col("copy"), _digits(48)),
    ]
    # per node: bytes before the open prefix, and the prefix found so far, one number per part of the key
    state = {n: {"before": 0, "prefix": []} for n in nodes}
    for part, (key, shifts) in enumerate(order):
        for n in state:
            state[n]["prefix"].append(0)
        for shift in shifts:
            open_rows = F.lit(False)
            for n, s in state.items():
                same = F.col("node") == n
                for p in range(part):
                    same = same & (order[p][0] == F.lit(s["prefix"][p]))
                if shift != shifts[0]:
                    above = shift + DIGIT_BITS
                    same = same & (F.shiftrightunsigned(key, above) == F.lit(s["prefix"][part] >> above))
                open_rows = open_rows | same
            digit = F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1).cast("long"))
            sums = table.where(open_rows).groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
            upto = W.partitionBy("node").orderBy("digit").rowsBetween(W.unboundedPreceding, 0)
            running = sums.withColumn("upto", F.sum("bytes").over(upto)).withColumn("values", F.count("*").over(W.partitionBy("node")))
            want = F.create_map(*[x for n, s in state.items() for x in (F.lit(n), F.lit(nodes[n]["_bytes"] / 2 - s["before"]))])
            crossing = running.where(F.col("upto") >= F.try_element_at(want, F.col("node"))).groupBy("node").agg(
                F.min_by(F.struct("digit", "bytes", "upto", "rows"), "digit").alias("at")
            )
            single = True
            for row in crossing.collect():  # one row per node
                s, at = state[row["node"]], row["at"]
                s["before"] += at["upto"] - at["bytes"]
                s["prefix"][part] |= at["digit"] << shift
                s["last"] = at["bytes"]
                single = single and at["rows"] == 1
            if single and shift == shifts[-1]:
                break
        if single:
            break
    right = F.lit(False)
    for n, s in state.items():
        half = nodes[n]["_bytes"] / 2
        stays = abs(s["before"] + s["last"] - half) <= abs(s["before"] - half)  # which side of the middle row
        beyond, equal = F.lit(False), F.lit(True)
        for (key, _), prefix in zip(order, s["prefix"], strict=False):
            beyond = beyond | (equal & (key > F.lit(prefix)))
            equal = equal & (key == F.lit(prefix))
        right = right | ((F.col("node") == n) & (beyond if stays else beyond | equal))
    return table.withColumn("node", F.col("node") * 2 + right.cast("int"))


def _slotted(table: DataFrame) -> DataFrame:
    """Slots: rows per shard and hash range are counted, the counts give offsets, a window does the rest."""
    rows = table.count()
    parts = max(1, rows // ROWS_PER_SLOT_RANGE, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    bits = min(20, max(1, (parts - 1).bit_length()))
    # rows with one hash are cut by copy number too
    table = table.withColumn("_range", F.struct(F.shiftrightunsigned("doc_hash", 64 - bits).alias("hash"), F.floor(F.col("copy") / COPIES_PER_RANGE).alias("copies")))
    counts = table.groupBy("node", "_range").agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy("node").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("node", "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("node", "_range").orderBy("doc_hash", "text_hash", "copy")
    return (
        table.withColumn("_row", F.row_number().over(inside))
        .join(offsets, ["node", "_range"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("node").alias("shard"),
            (F.col("_offset") + F.col("_row") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
