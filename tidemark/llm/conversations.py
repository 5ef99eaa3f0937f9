"""Repair of conversation structure by a suffix-shared DAWG.

A row has the role's initial and its first fault: blank (no text), duplicate (role
and text stood earlier in the conversation) or truncated (the text ends without
``.!?``). Edits: Keep; Rerole to user or assistant; Delete, which blanks and duplicates
require; Insert an empty user or assistant row. Roles must then read
``(s?(ua)+)?``. Of the cheapest edits those whose initials come first in ASCII count.

* Rows are sorted by conversation and turn over all tasks (a range shuffle, so one
  conversation may span many tasks) and cut into segments of at most ``SEGMENT_ROWS``
  rows and about ``SEGMENT_BYTES`` bytes. A segment's signature has one letter for
  each row: its role and fault, as far as edits tell them apart.
* Each distinct signature is kept once. Sorted by their reversed letters, signatures
  with a common end stand side by side. A task goes through them with the path of
  automaton nodes of the last one: a node is one end of signatures, the nodes that
  the next one shares are kept, the rest are made once each. A node holds, for each
  grammar state before it and after it, the cost and the edits' initials.
* Segments of a conversation are chained from its end, four states at a time; which
  way a segment goes on does not depend on edits after it, so only costs are carried.
* From the front the chosen edits are applied to the rows and the repaired text is
  hashed as it passes.

Tasks hold one segment and the path of one signature, whatever the length of a
conversation; only its audit, one letter for each edit, comes together in its row.
Whether a row stood earlier is found by aggregation on the whole row (a digest of its
text), before rows of a conversation meet.

Defined results: NULL roles and texts are one space, NULL turns come first; NULL
identifiers form a conversation of their own; rows of one turn are ordered by
role and text; equal rows are each a row, so all but the first are duplicates; an
empty text is blank; an empty table gives no rows. Only the four named columns are
read, whatever others there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import islice

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SEGMENT_ROWS, SEGMENT_BYTES = 256, 1 << 20
#: Costs of edits, roles, white space, characters that end a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
USER, ASSISTANT = "user", "assistant"
SPACES, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")

#: Grammar states: at the start, after a system, a user, an assistant row.
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = range(4)
#: Where an initial leads from each state; what an inserted or renamed row must be there.
KEEPS = {(START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
NEXT = {START: ASKED, SYSTEM: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
#: What still has to be inserted when a conversation ends in a state.
ENDING = {START: "", SYSTEM: "II", ASKED: "I", ANSWERED: ""}

#: Letters of a signature: role initial (o for others), upper case if truncated;
#: x if the row must go.
Edits = dict[tuple[int, int], tuple[int, str]]


# -- rows and faults ------------------------------------------------------------------


def prepared(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, place (what rows of one turn are ordered by)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.struct(role.alias("role"), F.sha2(text, 256).alias("text"), F.lit(0).alias("copy")).alias("place"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``prepared`` with known damage, by a checksum of identifier and turn:
    dropped, emptied, without sentence ends, repeated or given to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.withColumn("kind", kind).filter("kind != 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit(USER)).otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "place", F.explode(copies).alias("copy"))
    return rows.withColumn("place", F.col("place").withField("copy", F.col("copy"))).drop("copy")


def _order(turn: str = "turn") -> Column:
    """Sortable place of a row in its conversation."""
    return F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"), F.col("place").alias("place"))


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows, and the letter of their signature, fault and role initial. The
    first of equal rows is found by aggregation, not by collecting a conversation;
    the text meets it as a digest."""
    rows = rows.withColumn("order", _order()).withColumn("digest", F.sha2("text", 256))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("order").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(
        F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    marked = rows.join(firsts, same, "left").withColumn("end", F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)))
    fault = (
        F.when(F.col("end") == "", F.lit("blank"))
        .when(F.col("first").isNotNull() & (F.col("order") > F.col("first")), F.lit("duplicate"))
        .when(~F.col("end").isin(*ENDS), F.lit("truncated"))
    )
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    marked = marked.withColumn("fault", fault)
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit("x"))
        .when(F.col("fault") == "truncated", F.upper(letter))
        .otherwise(letter)
    )
    return marked.select("conv_id", "order", "role", "text", "fault", initial.alias("initial"), letter.alias("letter"))


# -- segments -------------------------------------------------------------------------

SEGMENT = (
    "conv_id long, part int, number int, signature string, initials array<string>, roles array<string>, texts array<string>,"
    " blank long, duplicate long, truncated long"
)


def segments(rows: DataFrame) -> DataFrame:
    """Rows with faults as segments in order: within a conversation by part, number.
    Rows equal in everything have one place in the order, so they come to one task, one
    behind the other, and all but the first are duplicates."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size, current, last = 0, None, None

        def segment() -> tuple:
            letters, initials, roles, texts, faults = zip(*held, strict=True)
            counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
            return (current, part, number, "".join(letters), list(initials), list(roles), list(texts), *counts)

        for batch in batches:
            out = []
            columns = [batch[c].tolist() for c in ("conv_id", "letter", "initial", "role", "text", "fault")]
            for conv, letter, initial, role, text, fault in zip(*columns, strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if last == (conv, role, text) and fault != "blank":
                    fault, letter = "duplicate", "x"
                last = (conv, role, text)
                if held and (conv != current or len(held) >= SEGMENT_ROWS or size >= SEGMENT_BYTES):
                    out.append(segment())
                    held, size, number = [], 0, number + 1
                current = conv
                held.append((letter, initial, role, text, fault))
                size += len(text) + len(role)
            if out:
                yield _frame(out)
        if held:
            yield _frame([segment()])

    names = [c.split()[0] for c in SEGMENT.split(", ")]

    def _frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    by = [F.col("conv_id"), F.col("order")]
    # Not by a fixed number of partitions: adaptive execution would merge small ones,
    # and parts stay in order either way.
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    return dealt.select("conv_id", "letter", "initial", "role", "text", "fault").mapInPandas(cut, SEGMENT)


# -- the automaton --------------------------------------------------------------------


@cache
def row_edits(letter: str) -> Edits:
    """Cheapest edits of one row between two states: cost and initials, insertions
    before the row included."""
    found: Edits = {}

    def offer(first: int, last: int, cost: int, edits: str) -> None:
        if (first, last) not in found or (cost, edits) < found[first, last]:
            found[first, last] = (cost, edits)

    for first in STATES:
        at = first
        for inserted in range(3):
            before, cost = "I" * inserted, INSERT * inserted
            offer(first, at, cost + DELETE, before + "D")
            if letter != "x":
                extra = TRUNCATED * letter.isupper()
                kept = KEEPS.get((at, letter.lower()))
                if kept is not None:
                    offer(first, kept, cost + extra, before + "K")
                offer(first, NEXT[at], cost + REROLE + extra, before + "R")
            at = NEXT[at]
    return found


def before(letter: str, rest: Edits) -> Edits:
    """The node one letter before another."""
    found: Edits = {}
    for (first, middle), (cost, edits) in row_edits(letter).items():
        for last in STATES:
            if (middle, last) in rest:
                more, after = rest[middle, last]
                offer = (cost + more, edits + after)
                if (first, last) not in found or offer < found[first, last]:
                    found[first, last] = offer
    return found


NOTHING: Edits = {(s, s): (0, "") for s in STATES}


class Automaton:
    """The path of nodes of the last signature, from its end."""

    def __init__(self):
        self.letters, self.nodes, self.made = "", [NOTHING], 0

    def edits(self, signature: str) -> Edits:
        backwards = signature[::-1]
        shared = 0
        for a, b in zip(self.letters, backwards, strict=False):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for letter in backwards[shared:]:
            self.nodes.append(before(letter, self.nodes[-1]))
        self.made += len(backwards) - shared
        self.letters = backwards
        return self.nodes[-1]


TABLE = "signature string, first array<int>, last array<int>, cost array<long>, edits array<string>"


def edit_tables(signatures: DataFrame) -> DataFrame:
    """For each distinct signature, the ways through it: state before and after,
    cost, edits."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton()
        for batch in batches:
            out = []
            for signature in batch["signature"]:
                ways = automaton.edits(signature)
                first, last = zip(*ways, strict=True)
                cost, edits = zip(*ways.values(), strict=True)
                out.append((signature, list(first), list(last), list(cost), list(edits)))
            yield pd.DataFrame(out, columns=["signature", "first", "last", "cost", "edits"])

    backwards = F.reverse("signature")
    dealt = signatures.select("signature").distinct().repartitionByRange(backwards).sortWithinPartitions(backwards)
    return dealt.mapInPandas(walk, TABLE)


# -- chaining -------------------------------------------------------------------------

CHOICE = "part int, number int, to array<int>, edits array<string>, cost array<long>"


def choices(light: DataFrame) -> DataFrame:
    """For each segment and each state before it: the state after it and the edits of
    the cheapest repair from there to the conversation's end, and its cost. Segments
    come from the end; four costs are carried from one to the next."""

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, costs = "none yet", []
        for batch in batches:
            out = []
            for row in batch.itertuples():
                conv = None if pd.isna(row.conv_id) else int(row.conv_id)
                if conv != current:
                    current, costs = conv, [INSERT * len(ENDING[s]) for s in STATES]
                best: list = [None] * 4
                for first, last, cost, edits in zip(row.first, row.last, row.cost, row.edits, strict=True):
                    offer = (int(cost) + costs[last], edits, int(last))
                    if best[first] is None or offer < best[first]:
                        best[first] = offer
                costs = [b[0] for b in best]
                out.append((row.part, row.number, [b[2] for b in best], [b[1] for b in best], costs))
            yield pd.DataFrame(out, columns=["part", "number", "to", "edits", "cost"])

    dealt = light.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("number"))
    return dealt.select("conv_id", "part", "number", "first", "last", "cost", "edits").mapInPandas(chain, CHOICE)


REPAIRED = (
    "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def applied(rows: list[tuple[str, str]], edits: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """Rows (role, text) after edits, and the state they lead to."""
    out, at = [], 0
    for edit in edits:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "K":
            state = KEEPS[state, role[:1]]
            out.append((role, text))
        elif edit != "D":
            state = NEXT[state]
            out.append((ASSISTANT if state == ANSWERED else USER, text))
    return out, state


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Segments with their edits, in order: conversation, segment, edits, repaired
    rows. After the last segment of a conversation comes what has to be inserted at
    its end, with None for the segment."""
    current, state = None, START
    for batch in batches:
        for row in batch.itertuples():
            conv = (None if pd.isna(row.conv_id) else int(row.conv_id),)
            if conv != current:
                if current is not None:
                    yield current[0], None, ENDING[state], applied([], ENDING[state], state)[0]
                current, state = conv, START
            edits = row.edits[state]
            lines, state = applied(list(zip(row.roles, row.texts, strict=True)), edits, state)
            yield conv[0], row, edits, lines
    if current is not None:
        yield current[0], None, ENDING[state], applied([], ENDING[state], state)[0]


def _frames(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in schema.split(", ")]
    while some := list(islice(rows, 1000)):
        yield pd.DataFrame(some, columns=names).astype({"conv_id": "Int64"})


LEGAL = {"su", "ua", "au"}


def _in_order(chosen: DataFrame) -> DataFrame:
    """The text of a conversation is one digest, so its segments pass through one
    task, in order and one at a time."""
    return chosen.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")


def repaired(chosen: DataFrame) -> DataFrame:
    """One row for each conversation: faults, illegal neighbours, cost, audit and the
    digest of the repaired text, which is fed to the hash segment by segment."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        new = True
        for conv, row, edits, lines in _walked(batches):
            if new:
                faults, illegal, cost, audit = [0, 0, 0], 0, int(row.cost[START]), []
                digest, between, last, new = hashlib.sha256(), b"", None, False
            for role, text in lines:
                digest.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                between = b"\n"
            audit.append(edits)
            if row is None:
                yield conv, *faults, illegal, cost, "".join(audit), digest.hexdigest()
                new = True
                continue
            faults = [a + int(b) for a, b in zip(faults, (row.blank, row.duplicate, row.truncated), strict=True)]
            for initial in row.initials:
                illegal += last is not None and last + initial not in LEGAL
                last = initial

    columns = ["conv_id", "blank", "duplicate", "truncated", "initials", "roles", "texts", "edits", "cost"]
    return _in_order(chosen).select(*columns).mapInPandas(lambda batches: _frames(digests(batches), REPAIRED), REPAIRED)


def _planned(rows: DataFrame) -> DataFrame:
    """Segments of rows with the edits for each state before them."""
    cut = stored(segments(with_faults(rows)), "conversation-segments")
    tables = stored(edit_tables(cut), "conversation-automaton")
    light = cut.select("conv_id", "part", "number", "signature").join(tables, "signature")
    return cut.join(stored(choices(light), "conversation-choices"), ["part", "number"])


def repair_rows(rows: DataFrame) -> DataFrame:
    """Repair of rows as ``prepared`` gives them: conv_id, gaps (turns that are
    lacking between the first and the last), blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256."""
    found = repaired(_planned(rows))
    turns = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).groupBy("conv_id")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0).cast("long"))
    gaps = turns.agg(gaps.alias("gaps")).withColumnRenamed("conv_id", "g_conv")
    both = found.join(gaps, F.col("conv_id").eqNullSafe(F.col("g_conv")))
    return both.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def repair(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """``repair_rows`` of a table with conv_id, turn, role and text, a row for each of its
    conversations; with ``damage`` its rows are damaged first, and a conversation that
    has none left counts as empty."""
    rows = prepared(conversations)
    found = repair_rows(damaged(rows) if damage else rows)
    every = rows.select(F.col("conv_id").alias("own_id")).distinct()
    both = every.join(found, F.col("own_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return both.select(
        F.col("own_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


RESULT = "conv_id long, part int, number int, at int, role string, text string"


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id; part, number and at (their
    order); role and text. Nothing is left of a conversation that loses all rows."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        place = (0, 0, 0)
        for conv, row, _, lines in _walked(batches):
            if row is not None:
                place = (row.part, row.number, 0)
            for role, text in lines:
                yield conv, *place, role, text
                place = (*place[:2], place[2] + 1)

    chosen = _in_order(_planned(prepared(conversations))).select("conv_id", "part", "number", "roles", "texts", "edits")
    return chosen.mapInPandas(lambda batches: _frames(rows(batches), RESULT), RESULT)
