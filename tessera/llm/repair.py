"""Conversation structure repair by weighted interval parsing.

The grammar derives a conversation's rows, each edited, so that the role
initials that remain spell ``(s?(ua)+)?``.  In Chomsky normal form its
nonterminals are the pairs (p, q) of the four places in that pattern: a span
of rows is a (p, q) if its edits lead from place p to place q.  The binary
rules are (p, q) -> (p, r) (r, q); a terminal is one row kept, reroled or
deleted; insertions need no row, so their closure (every chain of inserted
turns from p to q, the cheapest kept) is put around each terminal.  A span's
cell holds for each nonterminal the least (cost, audit): of equal costs the
audit that is least in ASCII.  Over one span no audit of equal cost begins
another (it would differ by insertions alone, which cost), so the least of a
whole is made of the least of its parts.

Cells are combined bottom-up by span length: rows, pairs, fours and so on.
Since the binary rules exist for every r, all ways to cut a span give the same
cell, and one cut a span is enough; the tests compare with all cuts.  Spans
are cut at partition borders too, so a conversation of any length is parsed by
many tasks: cells of its parts meet in rounds of ``FAN`` neighbours.  Only the
audit itself, one letter an edit, must fit a row, as the result has it.

Each row's first fault counts: blank, duplicate (its role and text stand
earlier), truncated.  First occurrences are found by an aggregate over
digests (SHA-256 of role and text), so a text that repeats meets in no task.

Null roles and texts are one space each; null turns come first; a null conv_id
is a conversation.  Rows of one turn are ordered as ``tessera.llm.turns`` says.
A conversation whose rows are all dropped has zeros and an empty audit.  An
empty table gives no rows.  Other columns are not read.

The repaired rows of a conversation stream in order through one task, which
holds one batch of them: the digest of the query is sequential.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, documents, flat_map_groups, same, small_batches, stored
from tessera.llm.registry import register
from tessera.llm.turns import ORDER, in_order, ordered_columns, part_of

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Summaries of neighbouring parts that one task combines at a time.
FAN = 16
#: Spans of at most so many rows have their cells remembered, by their kinds of rows.
MEMO_ROWS, MEMO = 16, 200_000

#: Places in (s?(ua)+)?: nothing yet, after s, after u, after a.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
PLACES = range(4)
#: Nonterminals that derive anything: no step leads back to places 0 and 1.
PAIRS = [(p, q) for p in PLACES for q in PLACES if p == q or (q > 0 if p == 0 else q > 1)]
BINARY = [[(PAIRS.index((p, r)), PAIRS.index((r, q))) for r in PLACES if (p, r) in PAIRS and (r, q) in PAIRS] for p, q in PAIRS]

WORD = r"[^\x20\x09-\x0D]"

Cell = tuple


def joined(x: Cell, y: Cell) -> Cell:
    """The cell of a span from those of its two halves."""
    return tuple(min(((x[a][0] + y[b][0], x[a][1] + y[b][1]) for a, b in rules if x[a] and y[b]), default=None) for rules in BINARY)


def _cell(steps: dict) -> Cell:
    return tuple(steps.get(pq) for pq in PAIRS)


def _closure() -> Cell:
    """The cheapest chains of insertions: none at all, then once more until nothing gets cheaper."""
    once = _cell({(p, p): (0, "") for p in PLACES} | {(p, q): (INSERT, "I") for (p, c), q in STEPS.items() if c in "ua"})
    while (more := joined(once, once)) != once:
        once = more
    return once


def _terminal(kind: str) -> Cell:
    """One row.  Kinds: its role initial (s, u, a, x for any other), in upper
    case if truncated; d if it must go."""
    steps = {(p, p): (DELETE, "D") for p in PLACES}
    if kind != "d":
        more = TRUNCATED if kind.isupper() else 0
        for (p, c), q in STEPS.items():
            edits = [(KEEP + more, "K")] if c == kind.lower() else []
            edits += [(REROLE + more, "R")] if c in "ua" else []
            if edits:
                steps[p, q] = min([*edits, *([steps[p, q]] if (p, q) in steps else [])])
    return _cell(steps)


CLOSURE = _closure()
ROWS = {k: joined(joined(CLOSURE, _terminal(k)), CLOSURE) for k in "suaxSUAXd"}
NO_ROWS = CLOSURE


def make_parser():
    """``parse(kinds)``: the cell of a run of rows, bottom-up by span length."""
    memo: dict[tuple[str, str], Cell] = {}

    def both(a: tuple[str, Cell], b: tuple[str, Cell]) -> tuple[str, Cell]:
        kinds = a[0] + b[0]
        if len(kinds) > MEMO_ROWS:
            return kinds, joined(a[1], b[1])
        found = memo.get((a[0], b[0]))
        if found is None:
            if len(memo) >= MEMO:
                memo.clear()
            found = memo[a[0], b[0]] = joined(a[1], b[1])
        return kinds, found

    def parse(kinds: str) -> Cell:
        spans = [(k, ROWS[k]) for k in kinds]
        while len(spans) > 1:
            spans = [both(*spans[k:k + 2]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
        return spans[0][1] if spans else NO_ROWS

    return parse


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the whole conversation."""
    return min(cell[PAIRS.index((0, q))] for q in ACCEPTED if cell[PAIRS.index((0, q))])


# ------------------------------------------------------- parts of a conversation
LEGAL = ("su", "ua", "au")


class Part(NamedTuple):
    """What the rows of one part say; ``low`` and ``high`` are its least and largest turn."""

    n: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str | None
    last: str | None
    turns: int
    low: int | None
    high: int | None
    costs: list
    audits: list

    @property
    def cell(self) -> Cell:
        return tuple(None if c is None else (c, a) for c, a in zip(self.costs, self.audits))


_PART = ("n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
         "turns long, low long, high long, costs array<bigint>, audits array<string>")


def _split(cell: Cell) -> tuple[list, list]:
    return [c and c[0] for c in cell], [c and c[1] for c in cell]


def followed(a: Part, b: Part) -> Part:
    """The summary of two neighbours."""
    if not a.n or not b.n:
        return a if a.n else b
    known = [x for x in (a.low, b.low) if x is not None]
    return Part(a.n + b.n, a.blank + b.blank, a.duplicate + b.duplicate, a.truncated + b.truncated,
                a.illegal + b.illegal + (a.last + b.first not in LEGAL), a.first, b.last,
                a.turns + b.turns - (a.high is not None and a.high == b.low),
                min(known, default=None), b.high if b.high is not None else a.high, *_split(joined(a.cell, b.cell)))


def summarise_rows():
    """``one(key, rows)`` for the rows of a part, in order: conv_id, part, turn,
    initial, blank, truncated, times, lead, digest, salt."""
    parse = make_parser()

    def one(key, rows):
        kinds, initials, turns, before = [], [], [], None
        blank = duplicate = truncated = 0
        for _, _, turn, initial, empty, cut, times, lead, digest, salt in rows:
            if not times:
                continue
            if turn is not None and turns[-1:] != [turn]:
                turns.append(turn)
            again, before = (digest, turn, salt) == before, (digest, turn, salt)
            fresh = 0 if empty else int(lead and not again)
            initials += [initial] * times
            blank += times if empty else 0
            duplicate += 0 if empty else times - fresh
            if fresh:
                truncated += cut
                kind = initial if initial in ("s", "u", "a") else "x"
                kinds.append(kind.upper() if cut else kind)
            kinds += "d" * (times - fresh)
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        return [(*key, *Part(len(kinds), blank, duplicate, truncated, illegal, initials[0] if initials else None,
                             initials[-1] if initials else None, len(turns), turns[0] if turns else None,
                             turns[-1] if turns else None, *_split(parse("".join(kinds)))))]

    return one


def merge_parts():
    """``one(key, rows)`` for summaries of neighbours: conv_id, to, part, summary."""
    return lambda key, rows: [(*key, *functools.reduce(followed, (Part(*r[3:]) for r in rows)))]


def _summaries(rows: DataFrame) -> DataFrame:
    """conv_id and its summary, from rows (conv_id, turn, role, text, times)."""
    known = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "times")
    facts = ordered_columns(known).select(
        *ORDER, "times", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(WORD)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
    placed = stored(in_order(facts).drop("role", "head"), "repair-rows")
    leads = placed.where("times > 0 and not blank").groupBy("conv_id", "digest").agg(F.min(F.struct("turn", "salt")).alias("at")) \
        .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("at.turn").alias("t"), F.col("at.salt").alias("s"), F.lit(True).alias("lead"))
    on = same(F.col("conv_id"), F.col("c")) & (F.col("digest") == F.col("d")) & same(F.col("turn"), F.col("t")) & (F.col("salt") == F.col("s"))
    flagged = placed.join(leads, on, "left").select(
        "conv_id", part_of().alias("part"), "turn", "initial", "blank", "truncated", "times", F.coalesce("lead", F.lit(False)).alias("lead"),
        "digest", "salt", "seq")
    dealt = flagged.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "seq").drop("seq")
    parts = stored(flat_map_groups(dealt, ["conv_id", "part"], summarise_rows, f"conv_id long, part int, {_PART}"), "repair-parts")
    last = parts.agg(F.max("part")).first()[0] or 0
    while last:
        near = parts.withColumn("to", F.floor(F.col("part") / FAN).cast("int")).select("conv_id", "to", "part", *Part._fields)
        near = near.repartition("conv_id", "to").sortWithinPartitions("conv_id", "to", "part")
        parts, last = stored(flat_map_groups(near, ["conv_id", "to"], merge_parts, f"conv_id long, part int, {_PART}"), "repair-parts"), last // FAN
    return parts.drop("part")


def repair_plans(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every
    conversation.  ``rows``: conv_id, turn, role, text (not null) and, if a row
    stands several times in a row or not at all, ``times``."""
    if "times" not in rows.columns:
        rows = rows.withColumn("times", F.lit(1))
    found = _summaries(rows)
    whole = [PAIRS.index((0, q)) for q in ACCEPTED]
    ways = F.array_min(F.filter(F.array(*[F.struct(F.col("costs")[k].alias("cost"), F.col("audits")[k].alias("audit")) for k in whole]),
                                lambda x: x["cost"].isNotNull()))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return found.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", ways.alias("way")) \
        .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "way.cost", "way.audit")


# ----------------------------------------------------------------- repaired rows
_ROW = "conv_id long, position long, edit string, turn long, role string, text string"


def _apply(struct: T.StructType):
    """Rows of conversations in order, each after a row with its audit -> repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(struct)
        audit, at, place, position = "", 0, 0, 0
        for b in batches:
            done = []

            def emit(edit, turn, role, text):
                nonlocal place, position
                done.append((conv, position, edit, turn, role, text))
                place, position = STEPS[place, role[0]], position + 1

            def insertions():
                nonlocal at
                while audit[at:at + 1] == "I":
                    emit("I", None, NEXT[place], "")
                    at += 1

            for conv, kind, turn, role, text, times, plan in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    audit, at, place, position = plan, 0, 0, 0
                    insertions()
                    continue
                for _ in range(times):
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        emit(edit, turn, role, text)
                    elif edit == "R":
                        emit(edit, turn, NEXT[place], text)
                    insertions()
            cols = list(zip(*done)) if done else [()] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    return run


#: The role that an inserted or reroled turn takes at each place.
NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, position, edit (K, R or I), turn, role, text of the rows that the
    audits leave, by conversation and in order within each partition."""
    if "times" not in rows.columns:
        rows = rows.withColumn("times", F.lit(1))
    known = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "times")
    both = ordered_columns(known.where("times > 0")).withColumns({"kind": F.lit(1), "audit": F.lit(None).cast("string")}).unionByName(
        plans.select("conv_id", "audit", F.lit(0).alias("kind")), allowMissingColumns=True)
    dealt = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:]) \
        .select("conv_id", "kind", "turn", "role", "text", "times", "audit")
    small_batches(rows.sparkSession)
    struct = T.StructType.fromDDL(_ROW)
    return dealt.mapInArrow(_apply(struct), struct)


def row_digests(rows: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of ``role:text`` by lines, of what ``repaired`` returns."""
    struct = T.StructType.fromDDL("conv_id long, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(struct)
        conv, sha = None, None

        def batch(done):
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(out)], schema=out)

        for b in batches:
            done = []
            for i, position, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if position == 0:
                    if sha:
                        done.append((conv, sha.hexdigest()))
                    conv, sha = i, hashlib.sha256()
                sha.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            yield batch(done)
        yield batch([(conv, sha.hexdigest())] if sha else [])

    return rows.select("conv_id", "position", "role", "text").mapInArrow(run, struct)


# ------------------------------------------------------------------------- query
def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, times: the damage of the query's contract."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    text = F.when(h == 1, "").when(h == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return conversations.select("conv_id", "turn", F.when(h == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
                                F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("times"))


@register("op11_repair")
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(documents(spark, sf_dir, "conversations"))
    plans = stored(repair_plans(rows), "repair-plans")
    digests = row_digests(repaired(rows, plans)).withColumnRenamed("conv_id", "c")
    return plans.join(digests, same(F.col("conv_id"), F.col("c")), "left").select(
        *plans.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
