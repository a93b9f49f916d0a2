"""Repair of the structure of conversations by survivor-coalescence Viterbi.

A conversation's rows, by turn (nulls first, then role and text), are edited so that the initials of its
roles read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user
or assistant row 2, and a truncated row that stays 1. Rows that are blank or repeat an earlier role and
text are deleted. Of the cheapest edits those count whose initials (K, R, D, I) are the least text.

The search (``survivors``) walks the rows with four states: nothing yet, a system row, a user row, an
assistant row. Rows are dealt out by ranges of conversation and turn, so one conversation may be spread over
many parts. Blocks of ``BLOCK`` rows are searched apart. A conversation inside a block is settled there;
of one that may go on before or behind it, the block gives the best way from each state to each. These
ways are the steps of a second search along the conversation's blocks, which reads a row for each block, in
order, and gives out a block's edits when all its survivors share them. The edits then go to the rows.

Defined results: nulls of role and text count as one space; rows equal in everything are one row with a
number of copies, the further ones repeat the first; a null conversation is one of its own; an empty
table has no rows; other columns are not looked at, whatever their names. The order of rows with one turn is
that of role and text, byte by byte. A conversation's audit is one text, so it must fit a cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.llm.base import stored, table
from silverlake.llm.merkle import crc32_sql
from silverlake.llm.positions import in_order
from silverlake.llm.survivors import Edge, Survivors

#: Rows that are searched at once.
BITS = 9
BLOCK = 1 << BITS
BLANKS = " \t\n\x0b\f\r"

# Costs of the edits and the legal pairs of initials.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = frozenset(["su", "ua", "au"])

NONE, SYSTEM, USER, ASSISTANT, END = range(5)
STATES = (NONE, SYSTEM, USER, ASSISTANT)
CLOSING: list[Edge] = [
    (NONE, END, 0, ""), (ASSISTANT, END, 0, ""), (USER, END, INSERT, "I"), (SYSTEM, END, 2 * INSERT, "II"),
]
# What one state needs at most beyond the cost of any way from the other: an inserted row or two, or the
# deletion of the system row that only a conversation without rows may keep.
EXTRA = {
    (NONE, SYSTEM): 0, (NONE, USER): INSERT, (NONE, ASSISTANT): 0,
    (SYSTEM, NONE): 2 * INSERT, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
    (USER, NONE): INSERT + DELETE, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, NONE): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
}


@lru_cache(maxsize=1024)
def row_edges(initial: str, fault: str, copies: int) -> tuple[Edge, ...]:
    """What may be done with a row and its copies: ``fault`` is ``x`` (must go), ``t`` (truncated) or empty.

    Rows are only inserted where the next one stays, or at the end: in front of a deleted row the same
    edits in the other order are the lesser text.
    """
    edges: list[Edge] = [(state, state, DELETE * copies, "D" * copies) for state in STATES]
    if fault == "x":
        return tuple(edges)
    rest, stays = "D" * (copies - 1), DELETE * (copies - 1) + (TRUNCATED if fault == "t" else 0)
    if initial == "s":
        edges.append((NONE, SYSTEM, stays, "K" + rest))
    for state in STATES:
        for insert in (0, 1):
            # The row becomes what is due behind this state, or behind it and an inserted row.
            to = ASSISTANT if (state == USER) != bool(insert) else USER
            keeps = initial == ("a" if to == ASSISTANT else "u")
            edges.append((state, to, stays + INSERT * insert + (0 if keeps else REROLE), "I" * insert + ("K" if keeps else "R") + rest))
    return tuple(edges)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults by the CRC-32 of conversation and turn, as conv_id, turn, role, text, copies."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    said = text_of("text")
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )


class Repair:
    """The repair of ``turns`` (conv_id, turn, role, text); ``copies`` names a column if rows stand for several.

    ``slices``: conv_id, block, whole (the conversation has no other slice), audit and the repaired
    ``turns`` of the slice in order. ``faults``: a row for each row or block with the counts of one conversation.
    """

    def __init__(self, turns: DataFrame, copies: str | None = None) -> None:
        number = F.col(copies) if copies else F.lit(1)
        text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        known = turns.select("conv_id", "turn", text_of("role"), text_of("text"), number.alias("copies"))
        # Equal rows are counted in the map tasks, so any number of them is one row from here on.
        key = ["conv_id", "turn", "role", "text"]
        rows = in_order(known.groupBy(*key).agg(F.sum("copies").alias("copies")), key, "mark")
        self.rows = rows.withColumn("block", F.shiftright("mark", BITS))
        self.kind = turns.schema["conv_id"].dataType.simpleString()
        marked = stored(self._marked(), "marked")
        found = stored(self._searched(marked), "searched")
        plan = stored(found.where("whole").select(*PLAN).unionByName(self._chained(found.where("NOT whole"))), "plan")
        self.slices = stored(self._applied(plan), "slices")
        self.faults = self._counts(marked, plan)

    def _marked(self) -> DataFrame:
        """Rows without their texts: initial, whether the row is blank, repeats an earlier turn, is truncated."""
        end = F.rtrim("text", F.lit(BLANKS))
        rows = self.rows.select(
            "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), "copies", "mark", "block",
            (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        )
        turn = F.struct("turn")  # a null is the least
        said = ["conv_id", "role", "digest"]
        again = rows.groupBy(*said).agg(F.min(turn).alias("first"), F.max(turn).alias("last")).where("first < last")
        again = stored(again.select(*[F.col(c).alias(f"_{c}") for c in said], "first"), "again")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in said]
        both = rows.join(again, same[0] & same[1] & same[2], "left")
        later = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
        return both.select(
            "conv_id", "turn", "copies", "mark", "block", F.substring("role", 1, 1).alias("initial"), "blank",
            (later & ~F.col("blank")).alias("repeats"),
            (F.col("truncated") & ~later & ~F.col("blank")).alias("truncated"),
        )

    def _searched(self, marked: DataFrame) -> DataFrame:
        fault = F.when(F.col("blank") | F.col("repeats"), "x").when(F.col("truncated"), "t").otherwise("")
        rows = marked.select("conv_id", "block", "mark", "initial", fault.alias("fault"), "copies")
        schema = (
            f"conv_id {self.kind}, block long, whole boolean, start int, audit string, cost long, illegal long, "
            "first string, last string, costs array<long>, audits array<string>"
        )
        return rows.groupBy("block").applyInArrow(_search_block, schema)

    def _chained(self, ways: DataFrame) -> DataFrame:
        """The edits of the conversations that touch a block's border: a small row for each block, in order."""
        schema = f"conv_id {self.kind}, block long, whole boolean, start int, audit string, cost long, illegal long"
        ordered = ways.repartition("conv_id").sortWithinPartitions("conv_id", "block")
        return ordered.mapInArrow(_chain, schema).select(*PLAN)

    def _applied(self, plan: DataFrame) -> DataFrame:
        schema = f"conv_id {self.kind}, block long, whole boolean, audit string, turns array<struct<role:string,text:string>>"
        rows = self.rows.select("conv_id", "block", "mark", "role", "text", "copies")
        edits = plan.select("conv_id", "block", "whole", "start", "audit")
        return rows.groupBy("block").cogroup(edits.groupBy("block")).applyInArrow(_apply, schema)

    def _counts(self, marked: DataFrame, plan: DataFrame) -> DataFrame:
        zero, n = F.lit(0).cast("long"), F.col("copies")
        one = F.coalesce(F.col("blank") | F.col("repeats"), F.lit(False))
        rows = marked.select(
            "conv_id",
            F.when(F.col("blank"), n).otherwise(zero).alias("blank"),
            F.when(F.col("blank"), zero).when(one, n).otherwise(n - 1).alias("duplicate"),
            F.col("truncated").cast("long").alias("truncated"),
            zero.alias("illegal"),
            zero.alias("cost"),
        )
        return rows.unionByName(
            plan.select("conv_id", *[zero.alias(c) for c in ("blank", "duplicate", "truncated")], "illegal", "cost")
        )

    def turns(self) -> DataFrame:
        """The repaired rows: conv_id, place (grows along the conversation), role, text."""
        listed = self.slices.select("conv_id", "block", F.posexplode("turns").alias("at", "said"))
        return listed.select("conv_id", F.struct("block", "at").alias("place"), "said.role", "said.text")

    def digests(self) -> DataFrame:
        """conv_id, audit and repaired_sha256, of the ``role:text`` of all rows joined by line ends.

        The slices of a conversation that has several pass one task in their order, piece by piece, as a
        SHA-256 can be made in no other way; nothing is gathered there.
        """
        lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
        whole = F.col("whole")
        said = F.array_join(lines, "\n")
        alone = self.slices.where(whole).select("conv_id", "audit", F.sha2(said, 256).alias("repaired_sha256"))
        rest = self.slices.where(~whole).select("conv_id", "block", "audit", F.size("turns").alias("rows"), said.alias("said"))
        rest = rest.repartition("conv_id").sortWithinPartitions("conv_id", "block")
        return alone.unionByName(rest.mapInArrow(_digest, f"conv_id {self.kind}, audit string, repaired_sha256 string"))


PLAN = ("conv_id", "block", "whole", "start", "audit", "cost", "illegal")


def _conversations(block: pa.Table, *columns: str) -> Iterator[tuple[object, list[tuple]]]:
    block = block.sort_by("mark")
    rows = zip(*(block.column(c).to_pylist() for c in ("conv_id", *columns)), strict=True)
    for conv, members in groupby(rows, key=lambda r: r[0]):
        yield conv, [r[1:] for r in members]


def illegal_pairs(initials: list[str], copies: list[int]) -> int:
    """Neighbours that are no legal pair; a row and its copy never are."""
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])) + sum(copies) - len(copies)


def _search_block(block: pa.Table) -> pa.Table:
    number, out = block.column("block")[0].as_py(), []
    conversations = list(_conversations(block, "initial", "fault", "copies"))
    for i, (conv, rows) in enumerate(conversations):
        whole = 0 < i < len(conversations) - 1
        initials, _, copies = map(list, zip(*rows, strict=True))
        row = {"conv_id": conv, "block": number, "whole": whole, "start": NONE}
        row |= {"illegal": illegal_pairs(initials, copies), "first": initials[0], "last": initials[-1]}
        if whole:
            ((_, cost, audit),) = _search(rows, NONE, closing=True)
            out.append(row | {"cost": cost, "audit": audit})
            continue
        found = {(s, to): (cost, audit) for s in STATES for to, cost, audit in _search(rows, s)}
        ways = [found.get((s, to), (None, None)) for s in STATES for to in STATES]
        out.append(row | {"costs": [w[0] for w in ways], "audits": [w[1] for w in ways]})
    kinds = [
        ("conv_id", block.schema.field("conv_id").type), ("block", pa.int64()), ("whole", pa.bool_()), ("start", pa.int32()),
        ("audit", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
        ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
    ]
    return pa.table({c: pa.array([r.get(c) for r in out], kind) for c, kind in kinds})


def _search(rows: list[tuple], start: int, closing: bool = False) -> list[tuple[int, int, str]]:
    """(state, cost, audit) of the best way from ``start`` through the rows to each state."""
    search, decided = Survivors(start, EXTRA), []
    for row in rows:
        decided += [label for _, label in search.step(row_edges(*row))]
    if closing:
        decided += [label for _, label in search.step(CLOSING)]
    done = "".join(decided)
    return [(state, cost, done + audit) for state, cost, audit in search.ways()]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one conversation after the other; a block's edits leave when they are decided."""
    names = ("conv_id", "block", "costs", "audits", "illegal", "first", "last")
    kinds = None
    current: object = _chain  # no conversation
    search = last = None
    held: list[list] = []  # the last decided block waits for what is inserted at the end

    def note(decided: list[tuple], out: list[list]) -> None:
        for (tag, origin), label in decided:
            if tag is None:
                held[0][4] += label
                continue
            if held:
                out.append(held.pop())
            block, illegal, only = tag
            held.append([current, block, only, origin, label, 0, illegal])

    def finish(out: list[list]) -> None:
        note(search.step(CLOSING), out)
        ((cost, _),) = search.best.values()
        held[0][5] = cost
        # A conversation that turns out to be in one block alone is whole.
        held[0][2] = blocks == 1
        out.append(held.pop())

    blocks = 0
    for batch in batches:
        out: list[list] = []
        kinds = batch.schema.field("conv_id").type
        for conv, block, costs, audits, illegal, first, end in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
            if search is None or conv != current:
                if search is not None:
                    finish(out)
                search, last, current, blocks = Survivors(NONE, EXTRA), None, conv, 0
            if last is not None:
                illegal += last + first not in LEGAL
            blocks, last = blocks + 1, end
            pairs = [(s, to) for s in STATES for to in STATES]
            edges = [(s, to, c, a) for (s, to), c, a in zip(pairs, costs, audits, strict=True) if c is not None]
            note(search.step(edges, (block, illegal, False)), out)
        yield _plan_batch(out, kinds)
    if search is not None:
        out = []
        finish(out)
        yield _plan_batch(out, kinds)


def _plan_batch(rows: list[list], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int64(), pa.bool_(), pa.int32(), pa.string(), pa.int64(), pa.int64())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(PLAN))


def replay(rows: list[tuple[str, str, int]], audit: str, state: int) -> list[dict[str, str]]:
    """The rows (role, text, copies) after the edits, from the state that they begin in."""
    out, at = [], 0

    def put(text: str) -> None:
        nonlocal state
        state = ASSISTANT if state == USER else USER
        out.append({"role": "assistant" if state == ASSISTANT else "user", "text": text})

    for role, text, copies in rows:
        while audit[at] == "I":
            put("")
            at += 1
        if audit[at] == "K":
            out.append({"role": role, "text": text})
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        elif audit[at] == "R":
            put(text)
        at += copies
    for _ in audit[at:]:
        put("")
    return out


def _apply(block: pa.Table, plan: pa.Table) -> pa.Table:
    names = ("conv_id", "block", "whole", "start", "audit")
    edits = {row[0]: row for row in zip(*(plan.column(c).to_pylist() for c in names), strict=True)}
    found = [
        (*edits[conv], replay(rows, edits[conv][4], edits[conv][3]))
        for conv, rows in _conversations(block, "role", "text", "copies")
    ]
    conv, number, whole, _, audit, turns = list(zip(*found, strict=True)) or [()] * 6
    said = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    columns = (conv, block.schema.field("conv_id").type), (number, pa.int64()), (whole, pa.bool_()), (audit, pa.string()), (turns, said)
    return pa.table([pa.array(values, kind) for values, kind in columns], ["conv_id", "block", "whole", "audit", "turns"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: object = _digest  # no conversation
    digest, audit, begun, kind = None, [], False, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 3
        kinds = (kind, pa.string(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        out, kind = [], batch.schema.field("conv_id").type
        names = ("conv_id", "audit", "rows", "said")
        for conv, letters, rows, said in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
            if digest is None or conv != current:
                if digest is not None:
                    out.append((current, "".join(audit), digest.hexdigest()))
                current, digest, audit, begun = conv, sha256(), [], False
            audit.append(letters)
            if rows:
                digest.update(b"\n" * begun + said.encode())
                begun = True
        yield batch_of(out)
    if digest is not None:
        yield batch_of([(current, "".join(audit), digest.hexdigest())])


def gaps(turns: DataFrame) -> DataFrame:
    """conv_id and how many turns are missing between its first and its last."""
    each = turns.select("conv_id", F.col("turn").cast("decimal(20,0)").alias("turn")).distinct()
    spans = each.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    return spans.select("conv_id", F.coalesce(F.col("gaps").try_cast("long"), F.lit(0)).alias("gaps"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repair = Repair(damage(rows), "copies")
    empty = F.lit(None).cast("string")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    texts = ("audit", "repaired_sha256")

    def part(frame: DataFrame) -> DataFrame:
        have = frame.columns
        return frame.select(
            "conv_id",
            *[(F.col(c) if c in have else F.lit(0)).cast("long").alias(c) for c in counts],
            *[(F.col(c) if c in have else empty).alias(c) for c in texts],
        )

    parts = part(rows.select("conv_id").distinct())
    for frame in (repair.faults, gaps(repair.rows), repair.digests()):
        parts = parts.unionByName(part(frame))
    # Sums of partial counts and one text each, so a conversation of any size is a row for each task.
    return parts.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


_SPACE = r"\x20\x09-\x0D"
SQL = f"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
listed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         substr(role, 1, 1) AS initial
  FROM damaged),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'b' WHEN nth > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][{_SPACE}]*$') THEN 't' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
  FROM listed),
-- States: 0 nothing, 1 system, 2 user, 3 assistant. An edit turns a row into one of these, or takes it away (0).
edits(origin, target, inserted, made) AS (
  VALUES (0, 0, 0, 0), (1, 1, 0, 0), (2, 2, 0, 0), (3, 3, 0, 0), (0, 1, 0, 1), (0, 2, 0, 2), (1, 2, 0, 2), (3, 2, 0, 2),
         (2, 3, 0, 3), (0, 3, 1, 3), (1, 3, 1, 3), (3, 3, 1, 3), (2, 2, 1, 2)),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state,
         {{'cost': CAST(0 AS BIGINT), 'audit': '', 'body': ''}} AS best FROM faults
  UNION ALL
  SELECT w.conv_id, f.pos, target,
         min({{'cost': best.cost + 2 * inserted + CASE WHEN made = 0 THEN 3 ELSE CAST(fault = 't' AS BIGINT)
                        + CASE WHEN initial = substr(' sua', made + 1, 1) THEN 0 ELSE 2 END END,
               'audit': best.audit || CASE WHEN inserted = 1 THEN 'I' ELSE '' END
                        || CASE WHEN made = 0 THEN 'D' WHEN initial = substr(' sua', made + 1, 1) THEN 'K' ELSE 'R' END,
               'body': best.body || CASE WHEN inserted = 0 THEN '' WHEN origin = 2 THEN chr(10) || 'assistant:'
                                         ELSE chr(10) || 'user:' END
                        || CASE WHEN made = 0 THEN '' WHEN initial = substr(' sua', made + 1, 1) THEN chr(10) || role || ':' || text
                                WHEN made = 2 THEN chr(10) || 'user:' || text ELSE chr(10) || 'assistant:' || text END}})
  FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = w.pos + 1 JOIN edits ON origin = state
  WHERE made = 0 OR fault NOT IN ('b', 'd') AND (made <> 1 OR initial = 's')
  GROUP BY w.conv_id, f.pos, target),
ends AS (
  SELECT w.conv_id,
         min({{'cost': best.cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
               'audit': best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
               'body': best.body || CASE state WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:'
                                               WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END}}) AS best
  FROM walk w JOIN (SELECT conv_id, max(pos) AS pos FROM faults GROUP BY conv_id) l
    ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.pos = w.pos
  GROUP BY w.conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""
