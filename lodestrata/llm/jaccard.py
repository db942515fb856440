"""N-gram Jaccard self-join of documents by set relations, and the components of its links.

A document's set holds the hashes of its distinct word shingles. Equal sets are one node. Links are found
exactly, without listing all pairs of a group of near copies:

1. *Leaders.* Nodes that share bands of minimum hashes with a node of more common bands are compared with it on the full
   sets; if similar (less than a link is enough) it leads them, and what they lack and add is kept.
2. *Derived answers.* The overlap of two members of one leader is that of both with a centre (the leader as
   most members have it), less its size, plus their common changes. Where the first part proves the link, all such members hang together by
   the best one; the other pairs are found by inverted lists of rare changes and settled on changes alone.
3. *Block-skip lists.* The rarest tokens of each set (a prefix that any linked set must meet, in an order
   by a frequency sketch, then hash) are the entries of inverted lists. Blocks of a leader's entries
   meet a node of a later leader only where sizes and positions leave room for the required overlap and
   the components found so far differ. Token counts by hash bucket bound the overlap of leader and node from above, which
   rules most pairs out that share boilerplate only. What is left is compared on the full sets, and the
   members' overlaps follow from what they lack and add.

Every link between different components is found, so components are exact (up to 64-bit hash collisions).
The order by the sketch (2 ** 18 counts over all documents) changes cost only, not results.

Defined results: null, empty and blank texts have an empty set and are a component of their own; texts
shorter than a shingle are one shingle; repeated rows and ties share a component. A null doc_id is never a
component's id unless all of its ids are null. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.components import components
from lodestrata.llm.small import joined
from lodestrata.llm.words import WordHashes, long_array, mixed, running, slices, spans, texts, windows
from lodestrata.sources.workspace import discard, materialise

SKETCH_BITS = 18
SKETCH_PARTS = 16
SEEN_SETS = 100_000
PROFILE_BUCKETS = 128
BANDS = 6
BAND_ROWS = 2


@dataclass(frozen=True)
class Similarity:
    """Link when ``per * intersection >= share * union`` of sets of ``words``-word shingles."""

    words: int = 5
    share: int = 80
    per: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.share * n // self.per) + 1

    def needed(self, sizes: Column) -> Column:
        """Least overlap of two sets with so many tokens in sum."""
        return F.ceil(sizes * self.share / (self.per + self.share))

    def linked(self, overlap: Column, sizes: Column) -> Column:
        return overlap * (self.per + self.share) >= sizes * self.share

    def sizes_fit(self, small: Column, large: Column) -> Column:
        return small * self.per >= large * self.share


def runs(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Shingle hashes of a text in order; that of all words if it has fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = hashes.of(words)
    return windows(own, n) if len(words) >= n else spans(running(own), np.zeros(1, np.int64), len(words))


def shingles(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(runs(text, n, hashes))


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def frequency_sketch(docs: DataFrame, n: int) -> np.ndarray:
    """Shingles per hash bucket; ``2 ** SKETCH_BITS`` numbers whatever the corpus.

    A task sends its counts as ``SKETCH_PARTS`` packed arrays, and the arrays of a part are added one by one.
    """
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in slices(batches):
            found = [runs(text, n, hashes) for text in texts(batch.column(0))]
            counts += np.bincount((np.concatenate(found) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        packed = [x.tobytes() for x in counts.reshape(SKETCH_PARTS, width)]
        yield pa.record_batch({"part": pa.array(range(SKETCH_PARTS), pa.int32()), "counts": pa.array(packed, pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.record_batch({"part": pa.array(list(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    shape = "part int, counts binary"
    rows = docs.select("text").mapInArrow(run, shape).repartition(SKETCH_PARTS, "part").mapInArrow(add, shape).collect()
    sketch = np.zeros((SKETCH_PARTS, width), np.int64)
    for row in rows:
        sketch[row["part"]] = np.frombuffer(bytes(row["counts"]), np.int64)
    return sketch.ravel()


_FACTORS = mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)  # odd: bijections


def _signature(tokens: np.ndarray) -> np.ndarray:
    """Band keys: minimum hashes of the set under several bijections, two by two."""
    least = [(tokens * factor).min() for factor in _FACTORS]
    rows = np.array(least, np.uint64).reshape(BANDS, BAND_ROWS)
    keys = np.zeros(BANDS, np.uint64)
    for i in range(BAND_ROWS):
        keys = mixed(keys ^ rows[:, i])
    return mixed(keys ^ np.arange(BANDS, dtype=np.uint64))


def profile(tokens: np.ndarray) -> bytes:
    """Tokens per hash bucket, as bytes where they fit and as 32-bit integers elsewhere."""
    counts = np.bincount((tokens & np.uint64(PROFILE_BUCKETS - 1)).astype(np.int64), minlength=PROFILE_BUCKETS)
    return counts.astype(np.uint8 if counts.max() < 256 else np.int32).tobytes()


def most_common(a: bytes, b: bytes) -> int:
    """The most tokens that two sets of these profiles can have in common."""
    x, y = (np.frombuffer(p, np.uint8 if len(p) == PROFILE_BUCKETS else np.int32).astype(np.int64) for p in (a, b))
    return int(np.minimum(x, y).sum())


def signatures(docs: DataFrame, like: Similarity) -> DataFrame:
    """``doc_id, text_md5, n, set_id, bands, profile, prefix`` per document, as a written table; the prefix holds its rarest tokens first."""
    session = docs.sparkSession.sparkContext
    sketch = session.broadcast(frequency_sketch(docs, like.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            sizes, ids, bands, profiles, prefixes = [], [], [], [], []
            for text in texts(batch.column(1)):
                tokens = shingles(text, like.words, hashes)
                n = len(tokens)
                sizes.append(n)
                ids.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                bands.append(_signature(tokens) if n else np.zeros(0, np.uint64))
                profiles.append(profile(tokens))
                often = sketch.value[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                prefixes.append(tokens[np.lexsort((tokens, often))[: like.prefix(n)]] if n else tokens)
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "text_md5": batch.column(2),
                    "n": pa.array(sizes, pa.int64()),
                    "set_id": pa.array(ids, pa.binary()),
                    "bands": long_array(bands),
                    "profile": pa.array(profiles, pa.binary()),
                    "prefix": long_array(prefixes),
                }
            )

    own = _own(docs).withColumn("text_md5", F.md5("text"))
    shape = "doc_id long, text_md5 string, n long, set_id binary, bands array<long>, profile binary, prefix array<long>"
    out = materialise(own.mapInArrow(run, shape), "signatures")
    sketch.destroy()
    return out


def _sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame, like: Similarity) -> DataFrame:
    """``node, n, tokens`` of the nodes ``ids``, from their texts; only these texts are read in full."""
    needed = materialise(nodes.select("node", "set_id", "label", "n").join(ids.select("node").distinct(), "node", "left_semi"), "needed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()  # what a task has sent lately, so repeated rows are sent once
        for batch in slices(batches):
            sets = {xxhash.xxh3_128_digest(s.tobytes()): s for s in (shingles(t, like.words, hashes) for t in texts(batch.column(1)))}
            sets = {i: s for i, s in sets.items() if i not in seen}
            seen = set(sets) if len(seen) > SEEN_SETS else seen | set(sets)
            yield pa.record_batch({"set_id": pa.array(list(sets), pa.binary()), "tokens": long_array(list(sets.values()))})

    wanted = _own(docs).where("text IS NOT NULL")
    wanted = joined(wanted, needed.select("label"), wanted["doc_id"].eqNullSafe(F.col("label")), "left_semi", 16)
    sets = wanted.mapInArrow(run, "set_id binary, tokens array<long>")
    return joined(sets, needed.drop("label"), "set_id", "inner", 48).select("node", "n", "tokens").dropDuplicates(["node"])


def _heads(nodes: DataFrame) -> DataFrame:
    """``node, head``: the node that most bands of a node name as their head.

    A band names the one of its nodes whose bands are the most common, of equal ones the smallest. A group of near copies shares
    nearly all bands with its head then, also where other texts that have a passage in common with it share some.
    """
    banded = nodes.select("node", F.explode("bands").alias("band"))
    several = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    banded = materialise(banded.join(several, "band"), "banded")
    common = banded.groupBy("node").agg(F.sum(F.floor(16 * F.log2("size"))).alias("common"))
    place = F.struct((-F.col("common")).alias("order"), F.col("node").alias("of"))
    named = banded.join(common, "node").groupBy("band").agg(F.min(place).alias("head"))
    votes = banded.join(named, "band").where("node <> head.of").groupBy("node", "head").agg(F.count("*").alias("votes"))
    top = votes.groupBy("node").agg(F.min(F.struct((-F.col("votes")).alias("votes"), "head")).alias("top"))
    return materialise(top.select("node", F.col("top.head.of").alias("head")), "heads")


def _similar(docs: DataFrame, nodes: DataFrame, heads: DataFrame, like: Similarity) -> DataFrame:
    """``leader, node, n, size, shared, lacks, adds`` of the nodes that are similar to their head."""
    own = _sets(docs, nodes, heads, like)
    own = own.join(heads, "node").select("node", "n", "tokens", F.col("head").alias("leader"))
    lead = _sets(docs, nodes, heads.select(F.col("head").alias("node")), like)
    lead = lead.select(F.col("node").alias("leader"), F.col("n").alias("size"), F.col("tokens").alias("_tokens"))
    both = own.join(lead, "leader").select(
        "leader", "node", "n", "size", F.array_except("_tokens", "tokens").alias("lacks"), F.array_except("tokens", "_tokens").alias("adds")
    )
    both = both.withColumn("shared", F.col("n") - F.size("adds"))
    near = 2 * like.share - like.per
    alike = F.col("shared") * (like.per + near) >= (F.col("n") + F.col("size")) * near
    return materialise(both.where(alike).dropDuplicates(["node"]), "similar")


def _members(docs: DataFrame, nodes: DataFrame, like: Similarity) -> DataFrame:
    """``leader, node, n, size, shared, lacks, adds``: nodes similar to their head, which leads them, and
    leaders without a similar head. ``size`` is the leader's, ``lacks`` its tokens that the node lacks,
    ``adds`` the node's own. A leader may be a member of another one; its set is what its members refer to."""
    heads = _heads(nodes)
    led = _similar(docs, nodes, heads, like)
    # a head may be unlike all that name it, so the rest names others, itself left out
    used = led.select("node").unionByName(heads.select(F.col("head").alias("node"))).distinct()
    heads = _heads(nodes.select("node", "bands").join(used, "node", "left_anti"))
    if not heads.isEmpty():
        led = led.unionByName(_similar(docs, nodes, heads, like))
    none = F.array().cast("array<long>")
    free = led.select("leader", "size").distinct().join(led.select(F.col("node").alias("leader")), "leader", "left_anti")
    free = free.select("leader", F.col("leader").alias("node"), F.col("size").alias("n"), "size", none.alias("lacks"), none.alias("adds"), F.col("size").alias("shared"))
    return materialise(led.select("leader", "node", "n", "size", "lacks", "adds", "shared").unionByName(free), "members")


def _centred(members: DataFrame, like: Similarity) -> DataFrame:
    """``leader, node, n, size, shared, changes, spare`` against the centre of a leader's members.

    A leader has changes of its own, which all members would have in common. The centre is the leader with
    every token changed that more than half of its members change; it is a set, not a node.
    """
    counts = members.groupBy("leader").agg(F.count("*").alias("members"))
    each = members.select("leader", F.explode("lacks").alias("token"), F.lit(True).alias("lack"))
    each = each.unionByName(members.select("leader", F.explode("adds").alias("token"), F.lit(False).alias("lack")))
    often = each.groupBy("leader", "token", "lack").agg(F.count("*").alias("times")).join(counts, "leader").where("2 * times > members")
    # more than half change each of these tokens, so there are at most twice as many as a member changes
    flips = often.groupBy("leader").agg(
        F.collect_list(F.when(F.col("lack"), F.col("token"))).alias("gone"), F.collect_list(F.when(~F.col("lack"), F.col("token"))).alias("new")
    )
    none = F.array().cast("array<long>")
    own = members.join(flips, "leader", "left").withColumns({"gone": F.coalesce("gone", none), "new": F.coalesce("new", none)})
    lacks = F.concat(F.array_except("lacks", "gone"), F.array_except("new", "adds"))
    adds = F.concat(F.array_except("adds", "new"), F.array_except("gone", "lacks"))
    size = F.col("size") - F.size("gone") + F.size("new")
    own = own.select("leader", "node", "n", size.alias("size"), (F.col("n") - F.size(adds)).alias("shared"), F.concat(lacks, adds).alias("changes"))
    weight = like.per + like.share
    spare = 2 * weight * F.col("shared") - 2 * like.share * F.col("n") - weight * F.col("size")
    return materialise(own.withColumn("spare", spare), "centred")


def _plainly_linked(members: DataFrame) -> DataFrame:
    """``node, component`` by the links that the overlaps with the centre prove. Two members link if their
    ``spare`` sums to 0 or more whatever they have in common beyond the centre, so all such pairs hang
    together by the best member, which names the component."""
    best = members.groupBy("leader").agg(F.max(F.struct("spare", "node")).alias("best"))
    met = members.join(best, "leader").where((F.col("node") == F.col("best.node")) | (F.col("spare") + F.col("best.spare") >= 0))
    return met.select("node", F.col("best.node").alias("component"))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more ``links``, which are first contracted to the components that they join."""
    ends = [found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b")]
    between = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).where("a <> b").distinct()
    between = materialise(between, "between")
    if between.isEmpty():
        return found
    roots = materialise(components(between).withColumnRenamed("component", "root"), "roots")
    moved = found.join(roots.withColumnRenamed("node", "component"), "component", "left")
    moved = moved.select("node", F.coalesce("root", "component").alias("component"))
    alone = roots.join(found, "node", "left_anti").select("node", F.col("root").alias("component"))
    return materialise(moved.unionByName(alone), "components")


def _changed_links(members: DataFrame, found: DataFrame, like: Similarity) -> DataFrame:
    """Components after links of one leader's members that need common changes: tokens that both lack or both add.

    The overlap of two members is ``shared + shared - size`` of the centre plus their common changes, so a pair with a
    negative sum of ``spare`` must meet in the rarest of its changes. Each list of a change is first compared with
    one member only, three times with another one (the nearest to the centre, the farthest, any), which joins groups of near copies in
    linear time. Then the pairs of different components that are left are compared, on their changes only.
    """
    unit = 2 * (like.per + like.share)
    best = members.groupBy("leader").agg(F.max("spare").alias("most"))
    own = members.join(best, "leader").withColumn("least", F.greatest(F.lit(1), F.ceil(-(F.col("spare") + F.col("most")) / unit)))
    own = materialise(own.where(F.size("changes") >= F.col("least")).select("leader", "node", "n", "size", "shared", "spare", "changes", "least"), "changed")
    each = own.select("leader", "node", "least", F.explode("changes").alias("change"))
    often = each.groupBy("leader", "change").agg(F.count("*").alias("times")).where("times > 1")
    # changes of one node alone come first in its order and meet nobody, so they only shorten the prefix
    ranked = each.join(often, ["leader", "change"]).groupBy("leader", "node", "least").agg(F.sort_array(F.collect_list(F.struct("times", "change"))).alias("met"))
    prefix = F.expr("slice(met, 1, cast(greatest(size(met) - least + 1, 0) as int))")
    entries = ranked.select("leader", "node", F.explode(prefix).alias("_c")).select("leader", "node", F.col("_c.change").alias("change"))
    entries = materialise(entries.join(own.select("node", "spare"), "node"), "changes")
    left = own.select(F.col("node").alias("node_a"), F.col("n").alias("na"), F.col("shared").alias("sa"), "size", F.col("changes").alias("ca"))
    right = own.select(F.col("node").alias("node_b"), F.col("n").alias("nb"), F.col("shared").alias("sb"), F.col("changes").alias("cb"))

    def links(met: DataFrame) -> DataFrame:
        ends = [F.least("node_a", "node_b").alias("node_a"), F.greatest("node_a", "node_b").alias("node_b")]
        both = met.select(*ends).distinct().join(left, "node_a").join(right, "node_b")
        overlap = F.col("sa") + F.col("sb") - F.col("size") + F.size(F.array_intersect("ca", "cb"))
        return both.where(like.linked(overlap, F.col("na") + F.col("nb"))).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    def placed() -> DataFrame:
        return entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))

    for order in (F.col("spare"), -F.col("spare"), F.xxhash64("node")):
        stars = placed().groupBy("leader", "change").agg(
            F.max(F.struct(order.alias("order"), "node", "spare", "component")).alias("star"), F.min("component").alias("least_of"), F.max("component").alias("most_of")
        )
        stars = materialise(stars.where("least_of < most_of").select("leader", "change", "star"), "stars")
        met = placed().join(stars, ["leader", "change"]).where("component <> star.component AND spare + star.spare < 0")
        found = _merged(found, links(met.select(F.col("node").alias("node_a"), F.col("star.node").alias("node_b"))))
        discard(stars)
    a, b = (placed().select("leader", "change", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "spare", "component"))) for x in "ab")
    met = a.join(b, ["leader", "change"]).where("node_a < node_b AND component_a <> component_b AND spare_a + spare_b < 0")
    found = _merged(found, links(met))
    discard(own, entries)
    return found


def _listed(nodes: DataFrame, members: DataFrame, found: DataFrame, like: Similarity) -> DataFrame:
    """``leader, node``: leaders and nodes of later leaders that inverted lists leave possible.

    Lists hold the prefix tokens that several nodes have. On one side entries are blocked by leader
    with their sizes and the most room that a position leaves; a block meets a node only where size
    and position allow the overlap, so whole blocks of a list are skipped.
    """
    tokens = nodes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("entries"))
    several = materialise(tokens.where("entries > 1").select("token"), "several")
    groups = materialise(members.select("node", "leader").join(found, "node", "full"), "groups")
    entries = joined(nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token")), several, "token", "left_semi", 16)
    entries = joined(entries.withColumn("room", F.col("n") - F.col("pos")).drop("pos"), groups, "node", "left", 32)
    entries = entries.withColumn("leader", F.coalesce("leader", "node")).withColumn("component", F.coalesce("component", "node"))
    entries = materialise(entries, "entries")
    discard(several, groups)
    blocks = entries.groupBy("token", "leader", "component").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("room").alias("space"))
    a = blocks.withColumnsRenamed({"leader": "first", "component": "group"})
    met = a.join(entries, "token").where(
        (F.col("first") < F.col("leader"))
        & (F.col("group") != F.col("component"))
        & like.sizes_fit(F.col("most"), F.col("n"))
        & like.sizes_fit(F.col("n"), F.col("least"))
        & (F.least("space", "room") >= like.needed(F.col("least") + F.col("n")))
    )
    out = materialise(met.select(F.col("first").alias("leader"), "node").distinct(), "listed")
    discard(entries)
    return out


def _possible(listed: DataFrame, nodes: DataFrame, members: DataFrame, like: Similarity) -> DataFrame:
    """The ``listed`` pairs of which some member of the leader may have the overlap that a link with the node needs: at most
    what the profiles of leader and node leave possible, and what the member adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            common = [most_common(a, b) for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(common, pa.int64())], ["leader", "node", "sizes", "adds", "common"])

    groups = members.groupBy("leader").agg(F.min("n").alias("least"), F.max(F.size("adds")).cast("long").alias("adds"))
    own = nodes.select("node", "n", "profile")
    pairs = listed.join(groups, "leader", "left").join(own, "node")
    lead = own.select(F.col("node").alias("leader"), F.col("n").alias("size"), F.col("profile").alias("_profile"))
    pairs = pairs.join(lead, "leader").select(
        "leader", "node", (F.coalesce("least", "size") + F.col("n")).alias("sizes"), F.coalesce("adds", F.lit(0)).alias("adds"), "profile", "_profile"
    )
    bounded = pairs.mapInArrow(run, "leader long, node long, sizes long, adds long, common long")
    return materialise(bounded.where(F.col("common") + F.col("adds") >= like.needed(F.col("sizes"))).select("leader", "node"), "possible")


def _outer_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, found: DataFrame, listed: DataFrame, like: Similarity) -> DataFrame:
    """Links between members of different leaders, derived from the overlap of a leader and a node: a member
    has what its leader has in common with the node, less what it lacks and more what it adds of the node."""
    ends = listed.select("node").unionByName(listed.select(F.col("leader").alias("node")))
    sets = materialise(_sets(docs, nodes, ends, like), "sets")
    lead = sets.select(F.col("node").alias("leader"), F.col("n").alias("size"), F.col("tokens").alias("_tokens"))
    met = listed.join(lead, "leader").join(sets, "node")
    met = materialise(met.select("leader", "node", "size", "n", F.size(F.array_intersect("tokens", "_tokens")).alias("common")).distinct(), "compared")
    direct = met.where(like.linked(F.col("common"), F.col("size") + F.col("n"))).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    inner = members.where("node <> leader").select("leader", F.col("node").alias("member"), F.col("n").alias("own"), F.col("shared"), "lacks", "adds")
    held = found.withColumnRenamed("component", "group")
    inner = inner.join(held.withColumnRenamed("node", "member"), "member", "left").withColumn("group", F.coalesce("group", "member"))
    outer = met.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    most = F.least(F.col("common") + F.size("adds"), "own", "n")
    open_ = outer.join(inner, "leader").where((F.col("group") != F.col("component")) & (most >= like.needed(F.col("own") + F.col("n"))))
    open_ = open_.select("node", "n", "common", "member", "own", "lacks", "adds")
    derived = open_.join(sets.select("node", "tokens"), "node")
    common = F.col("common") - F.size(F.array_intersect("lacks", "tokens")) + F.size(F.array_intersect("adds", "tokens"))
    more = derived.where(like.linked(common, F.col("own") + F.col("n"))).select(F.col("member").alias("a"), F.col("node").alias("b"))
    out = materialise(direct.unionByName(more).distinct(), "outer")
    discard(sets)
    return out


def jaccard_components(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``."""
    return _grouped(docs, like).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, like: Similarity) -> DataFrame:
    """``doc_id, text_md5, n_shingles, component, component_id``; ``component`` is null for empty sets."""
    full = signatures(docs, like)
    nodes = full.where("n > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("label"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("profile").alias("profile"), F.first("prefix").alias("prefix")
    )
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    signed = materialise(full.select("doc_id", "text_md5", "n", "set_id"), "signed")
    discard(full)
    linkable = nodes.where(F.col("n") * like.per >= (F.col("n") + 1) * like.share)  # smaller sets link to equal ones only

    members = _members(docs, linkable, like)
    centred = _centred(members, like)
    found = materialise(_plainly_linked(centred), "components")
    found = _changed_links(centred, found, like)
    discard(centred)
    listed = _listed(linkable, members, found, like)
    listed = _possible(listed, linkable, members, like)
    found = _merged(found, _outer_links(docs, nodes, members, found, listed, like))
    discard(members, listed)

    labelled = nodes.select("set_id", "node", "label").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("label").alias("component_id"))
    named = materialise(labelled.join(least, "component").select("set_id", "component", "component_id"), "named")
    discard(nodes)
    return joined(signed.select("doc_id", "text_md5", "n", "set_id"), named, "set_id", "left", 56).select(
        "doc_id",
        "text_md5",
        F.col("n").alias("n_shingles"),
        "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def distinct_documents(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """One row of every component, with the columns of ``documents``.

    The row is that of the smallest doc_id (null last), of several texts with this id the one with the
    smallest MD5, of equal rows one. Documents without words are all kept.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars")
    rows = materialise(_grouped(own, like).where("component IS NOT NULL").groupBy("component", "doc_id", "text_md5").agg(F.count("*").alias("rows")), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5")
    first = rows.groupBy(F.col("component").alias("_component")).agg(F.min(place).alias("_first"))
    same_group = F.col("component") == F.col("_component")
    dropped = rows.join(first, same_group).where(place != F.col("_first")).select(F.col("doc_id").alias("_doc"), F.col("text_md5").alias("_md5"))
    dropped = materialise(dropped, "dropped")
    repeated = materialise(rows.where("rows > 1").select(F.col("doc_id").alias("_doc"), F.col("text_md5").alias("_md5")), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.md5("text") == F.col("_md5"))
    if not repeated.isEmpty():
        once = joined(own, repeated, same, "left_semi", 56).withColumn("_md5", F.md5("text")).dropDuplicates(["doc_id", "_md5"]).drop("_md5")
        own = joined(own, repeated, same, "left_anti", 56).unionByName(once)
    return joined(own, dropped, same, "left_anti", 56)
