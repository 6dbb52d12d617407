"""Conversation repair: the lightest derivation of a well-formed conversation from its rows.

A conversation is well formed if its roles read: perhaps a system turn, then user and
assistant in turn, the assistant last; or if it is empty. A repair keeps, reroles, deletes
and inserts turns. Turns and beginnings of conversations are the items of a weighted deduction

    turn(letter, i, i + 1)  from row i, kept, reroled or deleted     turn(letter, i, i)  inserted
    path(r, j)              from path(q, i) and turn(letter, i, j), if the letter leads from q to r
    goal                    from path(q, n), if a conversation may end in q

whose weight is the cost of the edits and their initials, the audit. Costs add up and audits
join, so a conclusion is never lighter than what it is drawn from, and Knuth's agenda pops
items lightest first: a popped item is final, and when the goal is popped it is the answer.

Rows are sorted over all tasks, and a task repairs the conversations that lie whole in its
part. One that several tasks hold, or a very long one, goes by blocks of bounded size: the
lightest paths through each block, from every state to every other, are items of the
same deduction over the blocks.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.cluster import extended, ship, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: What a row's first fault is, if any.
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "."
WHITE = " \t\n\v\f\r"
ENDS = ".!?"
#: States: nothing yet, after system, after user, after assistant. A conversation ends in the first or last.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LAST = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Rows and characters of a block at most; one longer row stands alone.
ROWS, CHARACTERS = 256, 1 << 21
#: Shapes of conversations whose repair a worker remembers, and rows of the longest.
REMEMBERED, LONGEST = 1 << 15, 64


# --- the deduction --------------------------------------------------------------


class Agenda:
    """Items by weight: cost, then how much of the rows an item spans, then audit.

    Every conclusion costs more than each of its premises or spans more, so all
    derivations of an item are known before it is popped, and ties of cost fall to the least audit.
    """

    def __init__(self):
        self._heap: list = []
        self._best: dict = {}
        self.final: dict = {}

    def push(self, item: tuple, cost: int, size: int, audit: str, back=None) -> None:
        known = self._best.get(item)
        if known is None or (cost, audit) < known[:2]:
            self._best[item] = cost, audit, back
            heapq.heappush(self._heap, (cost, size, audit, item))

    def pop(self) -> tuple | None:
        """The lightest item that is not final yet, which becomes so, with its cost and audit."""
        while self._heap:
            cost, size, audit, item = heapq.heappop(self._heap)
            if item not in self.final:
                self.final[item] = self._best[item]
                return item, cost, size, audit
        return None


def lightest(rows: str, start: int, goal: bool) -> dict[int, tuple[int, str]]:
    """The lightest paths over ``rows``, two letters a row (its role's initial and fault), from a state.

    With ``goal`` only the lightest that may end a conversation, under its last state; else
    the lightest to each state that can be reached.
    """
    count = len(rows) // 2
    agenda = Agenda()
    agenda.push(("path", start, 0), 0, 1, "")
    for i in range(count):
        initial, fault = rows[2 * i], rows[2 * i + 1]
        agenda.push(("turn", "", i, i + 1), COSTS[DELETE], 1, DELETE)
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            if initial in "sua":
                agenda.push(("turn", initial, i, i + 1), COSTS[KEEP] + extra, 1, KEEP)
            for letter in NAMES:
                agenda.push(("turn", letter, i, i + 1), COSTS[REROLE] + extra, 1, REROLE)
    for i in range(count + 1):
        for letter in NAMES:
            agenda.push(("turn", letter, i, i), COSTS[INSERT], 0, INSERT)

    turns: list[list] = [[] for _ in range(count + 1)]
    paths: list[list] = [[] for _ in range(count + 1)]

    def combine(state, letter, end, cost, audit) -> None:
        after = STEP.get((state, letter)) if letter else state
        if after is not None:
            agenda.push(("path", after, end), cost, end + 1, audit)

    while found := agenda.pop():
        item, cost, size, audit = found
        if item[0] == "turn":
            _, letter, begin, end = item
            turns[begin].append((letter, end, cost, audit))
            for state, before, done in paths[begin]:
                combine(state, letter, end, before + cost, done + audit)
        elif item[0] == "path":
            _, state, place = item
            paths[place].append((state, cost, audit))
            for letter, end, more, edit in turns[place]:
                combine(state, letter, end, cost + more, audit + edit)
            if goal and place == count and state in LAST:
                agenda.push(("goal", state), cost, count + 2, audit)
        else:
            return {item[1]: (cost, audit)}
    return {state: (cost, audit) for state, cost, audit in paths[count]}


@lru_cache(REMEMBERED)
def _remembered(rows: str) -> tuple[int, str]:
    return next(iter(lightest(rows, 0, True).values()))


def cheapest(rows: str) -> tuple[int, str]:
    """Cost and audit of the repair of a whole conversation."""
    return _remembered(rows) if len(rows) <= 2 * LONGEST else next(iter(lightest(rows, 0, True).values()))


def through_blocks(blocks: list[list[tuple[int, str] | None]]) -> tuple[int, str, list[int]]:
    """Cost and audit of the repair of a conversation in blocks, and the state before each block.

    A block is given by the lightest paths through it: those from state q to state r at 4 * q + r.
    """
    agenda = Agenda()
    agenda.push(("path", 0, 0), 0, 1, "")
    count = len(blocks)
    while found := agenda.pop():
        item, cost, size, audit = found
        if item[0] == "goal":
            states = []
            while item := agenda.final[item][2]:
                states.append(item[1])
            return cost, audit, states[:0:-1]
        _, state, place = item
        if place < count:
            for after, path in enumerate(blocks[place][4 * state : 4 * state + 4]):
                if path is not None:
                    agenda.push(("path", after, place + 1), cost + path[0], place + 2, audit + path[1], item)
        elif state in LAST:
            agenda.push(("goal",), cost, count + 2, audit, item)
    raise AssertionError("every conversation can be emptied")


def edited(roles: list[str], texts: list[str], audit: str, state: int) -> Iterator[str]:
    """The repaired turns, as role:text, of rows that are edited from a state on."""
    row = 0
    for edit in audit:
        if edit == DELETE:
            row += 1
            continue
        letter = roles[row][0] if edit == KEEP else "a" if state == 2 else "u"
        text = "" if edit == INSERT else texts[row]
        yield f"{roles[row] if edit == KEEP else NAMES[letter]}:{text}"
        state = STEP[state, letter]
        row += edit != INSERT


# --- faults ---------------------------------------------------------------------


def faults(roles: list[str], texts: list[str], keys: list, seen: set) -> str:
    """Initial and first fault of each row, two letters a row; rows of equal keys are equal, and ``seen``
    holds the keys of the rows before."""
    out = []
    for role, text, key in zip(roles, texts, keys):
        end = text.rstrip(WHITE)
        if not end:
            fault = BLANK
        elif key in seen:
            fault = DUPLICATE
        else:
            fault = SOUND if end[-1] in ENDS else TRUNCATED
        seen.add(key)
        initial = role[:1]
        out.append((initial if initial in ("s", "u", "a") else "x") + fault)
    return "".join(out)


def _digest(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode(), usedforsecurity=False).digest()


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults that follow from conv_id and turn, as conv_id, turn, role, text and gone.

    The number crc32("conv_id:turn") % 20, with a blank for a null, is the fault: 0 the row is
    gone, 1 its text is empty, 2 the text lacks its full stops, exclamation and question
    marks, 3 the row stands twice, 4 the role is user. A null role or text is one blank.
    """
    blank = F.lit(" ")

    def name(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), blank)

    number = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(number == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(number == 1, "").when(number == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (number == 0).alias("gone"),
        F.when(number == 3, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


# --- conversations --------------------------------------------------------------

_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_BLOCK = "part long, block long, turns array<long>, roles array<string>, texts array<string>, digests array<binary>"
_FACTS = (
    "part long, block long, least long, most long, distinct long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, costs array<long>, audits array<string>"
)
_MERGED = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "parts array<long>, blocks array<long>, states array<int>, pieces array<string>"
)
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_COLUMNS = ["conv_id", *(f.split()[0] for f in _FOUND.split(", "))]


def _arrow(kind: pa.DataType, ddl: str) -> pa.Schema:
    """Arrow's schema of conv_id and the columns of a DDL of plain types and arrays of them."""
    fields = [pa.field("conv_id", kind)]
    for name, form in (f.split() for f in ddl.split(", ")):
        inner = _TYPES[form.removeprefix("array<").removesuffix(">")]
        fields.append(pa.field(name, pa.list_(inner) if form.startswith("array") else inner))
    return pa.schema(fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class _Run:
    """The rows of one conversation that a task has read, as far as they are not in a block yet."""

    def __init__(self, conv_id, alone: bool):
        self.conv_id = conv_id
        self.alone = alone  # whether all of its rows are here
        self.clear()

    def clear(self) -> None:
        self.turns, self.roles, self.texts, self.characters = [], [], [], 0

    def add(self, turn, role, text) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.characters += len(text)

    @property
    def full(self) -> bool:
        return len(self.turns) >= ROWS or self.characters >= CHARACTERS

    def result(self) -> tuple:
        """The repair of a whole conversation."""
        rows = faults(self.roles, self.texts, list(zip(self.roles, self.texts)), set())
        cost, audit = cheapest(rows)
        least, most, distinct = _span(self.turns)
        gaps = most - least + 1 - distinct if distinct else 0
        digest = hashlib.sha256("\n".join(edited(self.roles, self.texts, audit, 0)).encode()).hexdigest()
        return self.conv_id, gaps, *_counts(rows), _illegal(self.roles), cost, audit, digest, *[None] * 6

    def block(self, part: int, number: int) -> tuple:
        digests = [_digest(r, t) for r, t in zip(self.roles, self.texts)]
        row = self.conv_id, *[None] * 8, part, number, self.turns, self.roles, self.texts, digests
        self.alone = False
        self.clear()
        return row


def _span(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """Least, greatest and number of distinct turns that are known."""
    known = {t for t in turns if t is not None}
    return min(known, default=None), max(known, default=None), len(known)


def _counts(rows: str) -> list[int]:
    return [rows[1::2].count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED)]


def _cut(rows: DataFrame) -> DataFrame:
    """Sorted rows as results, of conversations that lie whole in a partition, and as blocks of all others."""
    found = f"{_FOUND}, {_BLOCK}"

    def run(batches):
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        number, weight = 0, 0
        current: _Run | None = None
        schema = None
        for batch in batches:
            schema = schema or _arrow(batch.schema.field("conv_id").type, found)
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone"))
            for conv_id, turn, role, text, gone in zip(*columns):
                ends = current is not None and conv_id != current.conv_id
                if ends and current.alone:
                    out.append(current.result())
                elif ends or current is not None and current.full and not gone:
                    out.append(current.block(part, number))
                    number += 1
                if ends or current is None:
                    # The first conversation of a partition may have begun in another.
                    current = _Run(conv_id, alone=ends)
                if not gone:
                    current.add(turn, role, text)
                    weight += len(text)
                if len(out) >= 4096 or (out and weight >= 4 * CHARACTERS):
                    yield _batch(out, schema)
                    out, weight = [], 0
        if current is not None:  # and the last may go on in another
            out.append(current.block(part, number))
            yield _batch(out, schema)

    return rows.mapInArrow(run, extended(rows.select("conv_id"), found))


def _earlier(blocks: DataFrame) -> DataFrame:
    """For each block (part, block) the digests in it that an earlier block of its conversation holds, too."""
    place = F.struct("part", "block")
    held = blocks.select("conv_id", place.alias("place"), F.explode(F.array_distinct("digests")).alias("digest"))
    first = held.groupBy("conv_id", "digest").agg(F.min("place").alias("first")).alias("f")
    held = held.alias("h")
    same = F.col("h.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("h.digest") == F.col("f.digest"))
    again = held.join(first, same & (F.col("h.place") > F.col("f.first")))
    return again.groupBy("h.place.part", "h.place.block").agg(F.collect_list("h.digest").alias("earlier"))


def _facts(blocks: DataFrame) -> DataFrame:
    """Counts of each block, and the lightest paths through it: from state q to state r at 4 * q + r."""

    def run(batches):
        for batch in batches:
            schema = _arrow(batch.schema.field("conv_id").type, _FACTS)
            out = []
            for row in batch.to_pylist():
                roles = row["roles"]
                rows = faults(roles, row["texts"], row["digests"], set(row["earlier"] or ()))
                cells = []
                for state in range(4):
                    paths = lightest(rows, state, False)
                    cells += [paths.get(after, (None, None)) for after in range(4)]
                ends = [roles[0][:1], roles[-1][:1]] if roles else [None, None]
                out.append((row["conv_id"], row["part"], row["block"], *_span(row["turns"]), *_counts(rows), _illegal(roles), *ends, *zip(*cells)))
            if out:
                yield _batch(out, schema)

    return blocks.mapInArrow(run, extended(blocks.select("conv_id"), _FACTS))


def _merge(facts: pa.Table) -> pa.Table:
    """The repair of one conversation, from the facts of its blocks."""
    rows = sorted(facts.to_pylist(), key=lambda r: (r["part"], r["block"]))
    spans = [r for r in rows if r["distinct"]]
    distinct = sum(r["distinct"] for r in spans) - sum(a["most"] == b["least"] for a, b in zip(spans, spans[1:]))
    gaps = spans[-1]["most"] - spans[0]["least"] + 1 - distinct if spans else 0
    held = [r for r in rows if r["first"] is not None]
    illegal = sum(r["illegal"] for r in rows) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(held, held[1:]))
    cells = [[None if c is None else (c, a) for c, a in zip(r["costs"], r["audits"])] for r in rows]
    cost, audit, states = through_blocks(cells)
    pieces = [paths[4 * state + after][1] for paths, state, after in zip(cells, states, states[1:])]
    pieces.append(audit[sum(map(len, pieces)) :])
    counts = [sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")]
    places = [r["part"] for r in rows], [r["block"] for r in rows]
    found = rows[0]["conv_id"], gaps, *counts, illegal, cost, audit, *places, states, pieces
    return pa.Table.from_batches([_batch([found], _arrow(facts.schema.field("conv_id").type, _MERGED))])


def _digests(blocks: DataFrame, merged: DataFrame) -> DataFrame:
    """The digest of each repaired conversation, taken block after block."""
    path = merged.select(F.explode(F.arrays_zip("parts", "blocks", "states", "pieces")).alias("p")).select(
        F.col("p.parts").alias("part"), F.col("p.blocks").alias("block"), F.col("p.states").alias("state"), F.col("p.pieces").alias("piece")
    )
    rows = blocks.select("conv_id", "part", "block", "roles", "texts").join(path, ["part", "block"])
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def run(batches):
        current, digest, begun = None, None, False
        schema = None
        for batch in batches:
            schema = schema or _arrow(batch.schema.field("conv_id").type, "repaired_sha256 string")
            out = []
            for row in batch.to_pylist():
                if digest is None or row["conv_id"] != current:
                    if digest is not None:
                        out.append((current, digest.hexdigest()))
                    current, digest, begun = row["conv_id"], hashlib.sha256(), False
                for line in edited(row["roles"], row["texts"], row["piece"], row["state"]):
                    digest.update(("\n" + line if begun else line).encode())
                    begun = True
            if out:
                yield _batch(out, schema)
        if digest is not None:
            yield _batch([(current, digest.hexdigest())], schema)

    return rows.mapInArrow(run, extended(blocks.select("conv_id"), "repaired_sha256 string"))


def repaired(conversations: DataFrame) -> DataFrame:
    """Faults and repair of every conversation of ``conversations`` (conv_id, turn, role, text, gone).

    Rows that are ``gone`` only say that their conversation is there. Rows go by turn, null
    first, equal turns by role and text (by 64 characters of each, and then by a hash of the
    text). The first fault of a row counts: blank, duplicate (an earlier row has its role and
    text), truncated (its last sign that is no blank ends no sentence). Keeping a row costs 0,
    giving it the role user or assistant 3, deleting it 4, inserting an empty turn 3; blank
    and duplicate rows are deleted, and a truncated one that is not costs 3 more. Of the
    cheapest repairs the one whose edits' initials are least is taken.

    Columns conv_id, gaps, blank, duplicate, truncated, illegal (neighbours other than system and
    user, user and assistant, assistant and user), cost, audit, and repaired_sha256 (of the
    repaired turns as role:text lines). Rows without conv_id are one conversation; repeated
    rows are duplicates; texts may be empty or very long; a conversation whose rows are all gone has zeros,
    an empty audit and the digest of nothing. An empty table gives no rows; other columns are
    left out. A conversation may fill many partitions, but its audit must fit in a row, and its digest
    is taken by one task, in order, from a stream of blocks.
    """
    ship(conversations.sparkSession)
    order = ["conv_id", "turn", "role_head", "text_head", "text_hash", "row"]
    rows = conversations.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "gone",
        F.substring("role", 1, 64).alias("role_head"),
        F.substring("text", 1, 64).alias("text_head"),
        F.xxhash64("text").alias("text_hash"),
        # Tells equal rows apart, so that any number of them can be dealt to several tasks.
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = written(_cut(rows.select("conv_id", "turn", "role", "text", "gone")))
    whole = cut.filter(F.col("part").isNull()).select(*_COLUMNS)
    blocks = cut.filter(F.col("part").isNotNull()).select("conv_id", *(f.split()[0] for f in _BLOCK.split(", ")))
    facts = _facts(blocks.join(_earlier(blocks), ["part", "block"], "left"))
    schema = extended(blocks.select("conv_id"), _MERGED)
    merged = written(facts.groupBy("conv_id").applyInArrow(_merge, schema))
    digests = _digests(blocks, merged).withColumnRenamed("conv_id", "id")
    long = merged.join(digests, merged.conv_id.eqNullSafe(digests.id))
    return whole.unionByName(long.select(*_COLUMNS))
