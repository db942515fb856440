"""Repair of conversations whose turns break the order ``(system? (user assistant)+)?``.

Edits: keep a row (0), give it the role user or assistant (3), delete it (4; a must for blank rows and duplicates), insert an
empty user or assistant row anywhere (3); a truncated row that stays adds 3. The audit is the string of the edits' initials
in order; of the cheapest ones the least in ASCII order is taken.

Wagner-Fischer against the grammar's strings: for a last role, all feasible targets are suffixes of one alternating string,
so one table ``cost[row][target letters left]`` holds the alignment to every length. It is filled from the last row up, only
inside Ukkonen's band around the diagonal: a greedy repair gives an incumbent cost, and no path that is at most as dear
leaves the diagonal by more than a third of it in inserts or a quarter in deletions. The lengths (and places of the
system row) that reach the least cost are traced back and their audits compared.

A letter of the audit and the role expected next fix the role expected after it. So a conversation can be cut: each slice
of ``SLICE`` rows is aligned for every pair of expected roles at its ends, with no insert behind its last row, and slices are
then put together by costs and audits alone. Conversations of up to ``SHORT`` rows and ``SHORT_BYTES`` are one list, and
one slice, in one task. Longer ones stay in rows, also if one holds a third of them: equal rows are gathered with their number,
the rest is range-sorted, numbered, sliced and aligned in parallel. Only their digest is made by one task, which
streams the texts in order with bounded memory, since SHA-256 has no parallel form.

Order and defined results: by turn (nulls first), then role, then text, so equal rows are neighbours. Null conv_id, turn, role and text
count as one blank in the hash and in rows; a null conv_id is a conversation of its own. Roles count by their first
character; other initials than ``s``, ``u``, ``a`` (or none) must go or be given a role. Conversations without rows after damage have
zeros, an empty audit and the digest of nothing. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.small import joined
from lodestrata.llm.words import slices
from lodestrata.sources.workspace import discard, materialise

SHORT = 1024
SHORT_BYTES = 4 << 20
SLICE = 512
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHOLE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # faults
FAR = 1 << 40
# Roles expected next: at the start, behind the system row, behind a user row, behind an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
CLOSING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


class Slice:
    """Rows of one conversation, as initials and faults, with alignment tables for either last role."""

    def __init__(self, initials: list[str], faults: list[int]):
        self.initials, self.faults, n = initials, faults, len(initials)
        self.stays = [f in (WHOLE, CUT) for f in faults]
        self.extra = [TRUNCATED if f == CUT else 0 for f in faults]
        most = self._incumbent()
        self.more, self.fewer = most // INSERT + 1, min(n, most // DELETE + 1)
        self.tables = {last: self._table(last) for last in (USER, ASSISTANT)}

    def _incumbent(self) -> int:
        """The cost of a greedy repair, with what any pair of ends may add."""
        cost, expected = 0, "u"
        for initial, stays, extra in zip(self.initials, self.stays, self.extra):
            if not stays:
                cost += DELETE
                continue
            cost += extra
            if initial != expected:
                cost += REROLE  # an insert, for u and a, costs the same
            expected = "u" if (initial if initial in ("u", "a") else expected) == "a" else "a"
        return cost + 2 * INSERT + DELETE + TRUNCATED

    def _letter(self, last: int, left: int) -> str:
        """The target's letter with so many left, itself included."""
        return "a" if (left % 2 == 1) == (last == ASSISTANT) else "u"

    def _table(self, last: int) -> np.ndarray:
        """``cost[i][d]``: rows from i on against ``n - i + d - fewer`` letters; ``d`` spans the band."""
        n, width = len(self.initials), self.more + self.fewer + 1
        cost = np.full((n + 1, width), FAR, np.int64)
        cost[n, self.fewer] = 0
        ramp = INSERT * np.arange(width)
        for i in range(n - 1, -1, -1):
            left = n - i + np.arange(width) - self.fewer
            row = np.full(width, FAR, np.int64)
            row[:-1] = cost[i + 1, 1:] + DELETE  # the same letters for one row less
            if self.stays[i]:
                matched = self.initials[i] == ("a" if last == ASSISTANT else "u")
                other = self.initials[i] == ("u" if last == ASSISTANT else "a")
                keeps = np.where(left % 2 == 1, matched, other)
                row = np.minimum(row, cost[i + 1] + self.extra[i] + np.where(keeps, 0, REROLE))
            row[left < 0] = FAR
            row = np.minimum.accumulate(row - ramp) + ramp
            row[left < 0] = FAR
            cost[i] = np.minimum(row, FAR)
        return cost

    def _cost(self, last: int, i: int, left: int) -> int:
        d = left - (len(self.initials) - i) + self.fewer
        return int(self.tables[last][i, d]) if left >= 0 and 0 <= d < self.tables[last].shape[1] else FAR

    def _lengths(self, last: int, i: int, first: str, least: int) -> list[tuple[int, int]]:
        """``(cost, letters left)`` at row i for all targets of at least ``least`` letters that begin with ``first``."""
        rest = len(self.initials) - i
        lengths = range(max(0, rest - self.fewer), rest + self.more + 1)
        return [(self._cost(last, i, k), k) for k in lengths if k >= least and (k == 0 or self._letter(last, k) == first)]

    def _trace(self, last: int, i: int, left: int) -> str:
        """The least audit of the cheapest ones from row i on."""
        out, n = [], len(self.initials)
        while i < n or left:
            here = self._cost(last, i, left)
            if i < n and self._cost(last, i + 1, left) + DELETE == here:
                out.append("D")
                i += 1
                continue
            if left and self._cost(last, i, left - 1) + INSERT == here:
                out.append("I")
                left -= 1
                continue
            out.append("K" if self.initials[i] == self._letter(last, left) else "R")
            i, left = i + 1, left - 1
        return "".join(out)

    def best(self, entry: int, leave: int) -> tuple[int, str] | None:
        """The least ``(cost, audit)`` between the roles expected before and after, if there is a way."""
        n = len(self.initials)
        if leave in (START, SYSTEM):
            found = [(DELETE * n, "D" * n)] if entry == leave else []
            if entry == START and leave == SYSTEM:
                found = [
                    (DELETE * (n - 1) + self.extra[i], "D" * i + "K" + "D" * (n - i - 1))
                    for i in range(n)
                    if self.initials[i] == "s" and self.stays[i]
                ]
            return min(found, default=None)
        ways = [(c, 0, k) for c, k in self._lengths(leave, 0, "a" if entry == USER else "u", 0 if entry == leave else 1)]
        if entry == START:
            for i in range(n):
                if self.initials[i] == "s" and self.stays[i]:
                    before = DELETE * i + self.extra[i]
                    ways += [(before + c, i + 1, k) for c, k in self._lengths(leave, i + 1, "u", 1)]
        least = min((c for c, _, _ in ways), default=FAR)
        if least >= FAR:
            return None
        return least, min(("D" * (i - 1) + "K" if i else "") + self._trace(leave, i, k) for c, i, k in ways if c == least)


def compose(parts: list[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[str], list[int]]:
    """The least cost of slices in a row, their audits (the last with closing inserts), and the role expected before each."""
    after = {q: cost for q, (cost, _) in CLOSING.items()}
    rest = [after]
    for part in reversed(parts):
        after = {p: min((c + after[q] for (e, q), (c, _) in part.items() if e == p), default=FAR) for p in CLOSING}
        rest.append(after)
    rest.reverse()
    entry, audits, entries = START, [], []
    for at, part in enumerate(parts):
        closing = {q: text if at == len(parts) - 1 else "" for q, (_, text) in CLOSING.items()}
        ways = [(w + closing[q], q) for (p, q), (c, w) in part.items() if p == entry and c + rest[at + 1][q] == rest[at][entry]]
        entries.append(entry)
        audit, entry = min(ways)
        audits.append(audit)
    return rest[0][START], audits, entries


def follow(audit: str, entry: int, initials: list[str]) -> Iterator[tuple[str, str | None, int | None]]:
    """``(edit, role given, row)``; inserts have no row, kept system rows leave the start."""
    at, row = entry, 0
    for edit in audit:
        role = ("assistant" if at == USER else "user") if edit in "IR" else None
        yield edit, role, None if edit == "I" else row
        if edit == "K" and at == START and initials[row] == "s":
            at = SYSTEM
        elif edit != "D":
            at = ASSISTANT if at == USER else USER
        if edit != "I":
            row += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows after damage, ``copies`` 0 for rows that it drops."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(filled("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


_FACTS = "blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string, repaired_sha256 string"
_FACT_TYPES = (*(pa.int64(),) * 6, pa.string(), pa.string())


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _faults(rows: list[tuple[str, str]]) -> list[int]:
    seen, out = set(), []
    for role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        out.append(BLANK if not words else DUPLICATE if (role, text) in seen else WHOLE if words[-1] in ".!?" else CUT)
        seen.add((role, text))
    return out


def _repair(rows: list[dict]) -> tuple:
    """All facts of one short conversation, its rows in order."""
    turns = {r["turn"] for r in rows} - {None}
    rows_after = [(r["role"], r["text"]) for r in rows for _ in range(r["copies"])]
    faults, initials = _faults(rows_after), [role[:1] for role, _ in rows_after]
    parts = []
    if rows_after:
        whole = Slice(initials, faults)
        parts = [{(START, q): way for q in CLOSING if (way := whole.best(START, q))}]
    cost, audits, _ = compose(parts)
    audit = "".join(audits)
    lines = [f"{role or rows_after[row][0]}:{'' if row is None else rows_after[row][1]}" for edit, role, row in follow(audit, START, initials) if edit != "D"]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = (faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), _illegal(initials), gaps)
    return *counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _FACTS.split(", ")]
    for batch in slices(batches, 256):
        facts = [_repair(rows) for rows in batch.column(1).to_pylist()]
        columns = list(zip(*facts)) or [()] * len(names)
        yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, _FACT_TYPES))], ["conv_id", *names])


def _slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a slice to its ways and to what counts need of it."""
    for batch in slices(batches, 256):
        out = []
        for rows in batch.column(2).to_pylist():
            initials = [r["initial"] for r in rows]
            part = Slice(initials, [r["fault"] for r in rows])
            found = [{"entry": p, "leave": q, "cost": way[0], "audit": way[1]} for p in CLOSING for q in CLOSING if (way := part.best(p, q))]
            out.append((found, _illegal(initials), initials[0], initials[-1]))
        columns = list(zip(*out)) or [()] * 4
        yield pa.record_batch(
            [*batch.columns[:2], *(pa.array(c, t) for c, t in zip(columns, _WAYS_TYPES))], ["conv_id", "slice", "ways", "illegal", "first", "last"]
        )


_WAYS = "slice long, ways array<struct<entry:int,leave:int,cost:long,audit:string>>, illegal long, first string, last string"
_WAY_TYPE = pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_WAYS_TYPES = (pa.list_(_WAY_TYPE), pa.int64(), pa.string(), pa.string())
_PLAN = "cost long, illegal long, plan array<struct<slice:long,entry:int,audit:string>>"
_PLAN_TYPE = pa.list_(pa.struct([("slice", pa.int64()), ("entry", pa.int32()), ("audit", pa.string())]))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's slices in order to its cost, illegal pairs and the audit of each slice."""
    for batch in slices(batches, 16):
        out = []
        for parts in batch.column(1).to_pylist():
            ways = [{(w["entry"], w["leave"]): (w["cost"], w["audit"]) for w in part["ways"]} for part in parts]
            cost, audits, entries = compose(ways)
            seams = sum(_illegal([a["last"], b["first"]]) for a, b in zip(parts, parts[1:]))
            plan = [{"slice": p["slice"], "entry": e, "audit": a} for p, e, a in zip(parts, entries, audits)]
            out.append((cost, seams + sum(p["illegal"] for p in parts), plan))
        columns = list(zip(*out)) or [()] * 3
        types = (pa.int64(), pa.int64(), _PLAN_TYPE)
        yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], ["conv_id", "cost", "illegal", "plan"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices sorted by conversation and place to one digest per conversation, held as a running state."""
    current, state, lines = None, None, 0

    def done() -> pa.RecordBatch:
        return pa.record_batch([current, pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    for batch in slices(batches, 16):
        for i, (entry, audit, rows) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("entry", "audit", "rows")))):
            conv = batch.column("conv_id").slice(i, 1)
            if state is None or not conv.equals(current):
                if state is not None:
                    yield done()
                current, state, lines = conv, hashlib.sha256(), 0
            for edit, role, row in follow(audit, entry, [r["role"][:1] for r in rows]):
                if edit != "D":
                    text = "" if row is None else rows[row]["text"]
                    state.update(f"{chr(10) if lines else ''}{role or rows[row]['role']}:{text}".encode())
                    lines += 1
    if state is not None:
        yield done()


def _long_facts(rows: DataFrame, kind: str) -> DataFrame:
    """Facts of long conversations, whose ``rows`` (after damage) stay rows."""
    copies = rows.select("*", F.explode(F.sequence(F.lit(1), "copies"))).drop("col", "copies")
    marked = materialise(copies.withColumn("n", F.monotonically_increasing_id()), "turns")  # tells equal rows apart
    count = marked.count()
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // 100_000))
    ranged = marked.repartitionByRange(parts, *order, F.substring("text", 1, 32), F.col("n")).sortWithinPartitions(*order, "text", "n")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    ordered = materialise(
        ranged.select(
            *("conv_id", "turn", "role", "text"), F.monotonically_increasing_id().alias("pos"), F.md5("text").alias("digest"), last.alias("last")
        ),
        "turns",
    )
    ordered = ordered.withColumn("slice", F.floor(F.col("pos") / SLICE))
    firsts = ordered.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("_first"))
    fault = (
        F.when(F.col("last") == "", BLANK).when(F.col("_first").isNull(), DUPLICATE).when(F.col("last").isin(".", "!", "?"), WHOLE).otherwise(CUT)
    )
    narrow = ordered.drop("text", "digest").join(firsts, "pos", "left").withColumn("fault", fault)
    narrow = materialise(narrow.select("conv_id", "slice", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "fault"), "faults")
    listed = F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows")
    ways = narrow.groupBy("conv_id", "slice").agg(listed).mapInArrow(_slice, f"conv_id {kind}, {_WAYS}")
    by_place = F.sort_array(F.collect_list(F.struct("slice", "ways", "illegal", "first", "last"))).alias("parts")
    plans = materialise(ways.groupBy("conv_id").agg(by_place).mapInArrow(_composed, f"conv_id {kind}, {_PLAN}"), "plans")
    turns = narrow.groupBy("conv_id", "turn").agg(*(F.sum((F.col("fault") == f).cast("long")).alias(f"f{f}") for f in (BLANK, DUPLICATE, CUT)))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0).cast("long"))
    counts = turns.groupBy("conv_id").agg(
        F.sum(f"f{BLANK}").alias("blank"), F.sum(f"f{DUPLICATE}").alias("duplicate"), F.sum(f"f{CUT}").alias("truncated"), gaps.alias("gaps")
    )
    texts = ordered.groupBy("conv_id", "slice").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("rows"))
    steps = plans.select(F.col("conv_id").alias("_conv"), F.explode("plan").alias("step")).select("_conv", "step.*").withColumnRenamed("slice", "_slice")
    applied = texts.join(steps, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice")))
    streamed = applied.select("conv_id", "slice", "entry", "audit", "rows").repartition("conv_id").sortWithinPartitions("conv_id", "slice")
    digests = streamed.mapInArrow(_digested, f"conv_id {kind}, repaired_sha256 string")
    whole = plans.select(F.col("conv_id").alias("_conv"), "cost", "illegal", F.array_join("plan.audit", "").alias("audit"))
    out = counts.join(whole, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    return out.join(digests.withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def repaired(conversations: DataFrame, short: int = SHORT, short_bytes: int = SHORT_BYTES) -> DataFrame:
    """One row per conversation of a table as :func:`damaged` gives it: ``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256``."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    size = F.sum(F.col("copies") * (F.octet_length("text") + F.octet_length("role"))).alias("_bytes")
    sizes = conversations.groupBy(F.col("conv_id").alias("_conv")).agg(F.sum("copies").alias("_rows"), size)
    long = materialise(sizes.where((F.col("_rows") > short) | (F.col("_bytes") > short_bytes)).select("_conv", F.lit(1).alias("_long")), "long")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    some = not long.isEmpty()
    near = joined(conversations, long, same, "left_anti", 24) if some else conversations
    listed = F.collect_list(F.when(F.col("copies") > 0, F.struct("turn", "role", "text", "copies")))
    lists = near.groupBy("conv_id").agg(F.sort_array(listed).alias("rows"))
    out = lists.mapInArrow(_short, f"conv_id {kind}, {_FACTS}").select(names)
    if some:
        far = joined(conversations.where("copies > 0"), long, same, "left_semi", 24)
        out = out.unionByName(_long_facts(far, kind).select(names))
    return out
