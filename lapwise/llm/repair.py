"""Conversation structure repair: the cheapest edits that make roles alternate, found while rows stream by.

Rows are dealt out by conversation and sorted by turn. A task reads its conversations row by row, across Arrow batches.
What it carries is one dynamic-programming state per place in the wanted structure, ``(s?(ua)+)?`` over the initials of
roles (s for a leading system row, u and a for a user's and an assistant's): the least cost of the rows so far and the
rank of the edits that lead there among equally dear ones. Per row and state it keeps one byte, the choice made. When a
conversation ends, its choices are walked back, and its rows are handed out again with their edits.

Choices and rows stay in memory up to a bound and then go to an unnamed scratch file of the task, which nothing else
reads and which is gone with the task. So a conversation of any length takes bounded memory. It takes one task, as its
edits depend on each other from the first row to the last.

An edit list is written as its initials: K keep, R change the role, D delete the row, I insert an empty row. Two lists that
are equally dear are told apart by these letters, the least in ASCII order being chosen. That can be decided row by row:
what is inserted counts to the row after it, so that lists have one piece per row; two different pieces differ before
either ends, and equal lists lead to the same state. Inserting before a row that is deleted is never best, as the same
insertion after it costs the same and D comes before I.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare

#: Costs of the edits, and of keeping a truncated row.
RETAG, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"

#: Bytes of one conversation's choices, and of its rows, that a task holds before they go to its scratch file.
SPOOL_BYTES = 16 * 1024 * 1024
OUT_ROWS = 2_000
#: Rows whose choices are walked back at a time.
BLOCK_ROWS = 1 << 16

# States: nothing yet, a system row, a user's row last, an assistant's last. Only the first and the last may end.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_FAR = 1 << 60

#: From each state, by the role of the next row: the state reached and the roles to insert before it.
_STEPS = {
    _NONE: {"s": (_SYSTEM, ""), "u": (_USER, ""), "a": (_ASSISTANT, "u")},
    _SYSTEM: {"u": (_USER, ""), "a": (_ASSISTANT, "u")},
    _USER: {"u": (_USER, "a"), "a": (_ASSISTANT, "")},
    _ASSISTANT: {"u": (_USER, ""), "a": (_ASSISTANT, "u")},
}
#: What has to be inserted after the last row.
_ENDINGS = {_NONE: "", _SYSTEM: "ua", _USER: "a", _ASSISTANT: ""}
_ROLES = {"u": "user", "a": "assistant"}

#: Every choice at a row: (state before, letter, role taken on, state after, roles inserted before, letters).
_CHOICES = [(state, "D", "", state, "", "D") for state in _STEPS] + [
    (state, letter, role, after, inserted, "I" * len(inserted) + letter)
    for letter in "KR"
    for state, steps in _STEPS.items()
    for role, (after, inserted) in steps.items()
    if letter == "K" or role != "s"
]
_NO_CHOICE = 255
_OF_ROW = {
    # By the initial a row may keep (none: it has to change or go); deletion alone where the fault demands it.
    initial: [k for k, c in enumerate(_CHOICES) if c[1] != "K" or c[2] == initial]
    for initial in ("s", "u", "a", "")
}
_DELETIONS = [k for k, c in enumerate(_CHOICES) if c[1] == "D"]
_BY_LETTERS = {letters: rank for rank, letters in enumerate(sorted({c[5] for c in _CHOICES}))}

_REPAIRED = "conv_id {kind}, place long, edit string, turn {turn}, was string, fault string, role string, text string"


@lru_cache(1 << 14)
def _step(cost: tuple, rank: tuple, initial: str, fault: str | None) -> tuple[tuple, tuple, bytes]:
    """Costs, ranks and choices of all states after a row. Costs differ by little from state to state, so that there are
    few cases, and a worker remembers them."""
    dear = TRUNCATED if fault == CUT else 0
    best: list[tuple | None] = [None] * 4
    for k in _DELETIONS if fault in (BLANK, DUPLICATE) else _OF_ROW[initial]:
        before, letter, _, after, inserted, letters = _CHOICES[k]
        if cost[before] >= _FAR:
            continue
        own = DELETE if letter == "D" else dear + (RETAG if letter == "R" else 0) + INSERT * len(inserted)
        found = (cost[before] + own, rank[before], _BY_LETTERS[letters], k)
        if best[after] is None or found < best[after]:
            best[after] = found
    # Ranks only compare the lists that lead to the states of one row, whatever they cost.
    ranks = {order: i for i, order in enumerate(sorted({b[1:3] for b in best if b}))}
    return (
        tuple(b[0] if b else _FAR for b in best),
        tuple(ranks[b[1:3]] if b else 0 for b in best),
        bytes(b[3] if b else _NO_CHOICE for b in best),
    )


class Repair:
    """The state of one conversation while its rows go by."""

    def __init__(self, spool_bytes: int = SPOOL_BYTES):
        self.cost: tuple[int, ...] = (0, _FAR, _FAR, _FAR)
        self.rank: tuple[int, ...] = (0, 0, 0, 0)
        self.choices = tempfile.SpooledTemporaryFile(max_size=spool_bytes)
        self.rows = 0

    def add(self, initial: str, fault: str | None) -> None:
        """The next row: the initial of its role, and its fault."""
        least = min(self.cost)
        ahead = tuple(min(c - least, _FAR) for c in self.cost)
        step, self.rank, chosen = _step(ahead, self.rank, initial if initial in _OF_ROW else "", fault)
        self.cost = tuple(min(least + c, _FAR) for c in step)
        self.choices.write(chosen)
        self.rows += 1

    def finish(self) -> tuple[int, str, tempfile.SpooledTemporaryFile]:
        """Least cost, the roles to insert at the end, and a file with the choice for each row, in order."""
        state = min((self.cost[s] + INSERT * len(e), self.rank[s], s) for s, e in _ENDINGS.items() if self.cost[s] < _FAR)[2]
        cost, ending = self.cost[state] + INSERT * len(_ENDINGS[state]), _ENDINGS[state]
        # Walked back block by block. Each block, four bytes a row, is replaced by the path through it, one byte a row.
        path, block, end = self.choices, BLOCK_ROWS, self.rows
        while end:
            first = (end - 1) // block * block
            path.seek(4 * first)
            held = path.read(4 * (end - first))
            taken = bytearray(end - first)
            for i in range(end - first - 1, -1, -1):
                taken[i] = held[4 * i + state]
                state = _CHOICES[taken[i]][0]
            path.seek(4 * first)
            path.write(taken)
            end = first
        return cost, ending, path

    def path(self, file) -> Iterator[tuple]:
        """The choice for each row, from the file that ``finish`` gave."""
        for first in range(0, self.rows, BLOCK_ROWS):
            file.seek(4 * first)
            yield from (_CHOICES[k] for k in file.read(min(BLOCK_ROWS, self.rows - first)))


class Rows:
    """Rows of a conversation to be read again: in memory, and beyond a bound in a scratch file."""

    def __init__(self, spool_bytes: int = SPOOL_BYTES):
        self.file, self.writer, self.spool_bytes = None, None, spool_bytes
        self.held, self.size = [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        # A slice stands for the memory of its whole batch, which is bounded as well.
        self.size += batch.get_total_buffer_size()
        if self.size > self.spool_bytes:
            if self.writer is None:
                self.file = tempfile.TemporaryFile()
                self.writer = pa.ipc.new_stream(self.file, batch.schema)
            for held in self.held:
                self.writer.write_batch(held)
            self.held, self.size = [], 0

    def read(self) -> Iterator[pa.RecordBatch]:
        if self.writer is not None:
            self.writer.close()
            self.file.seek(0)
            yield from pa.ipc.open_stream(self.file)
        yield from self.held


def first_fault(text: Column, repeated: Column) -> Column:
    """blank, duplicate or truncated, whichever holds first, or null: text without anything but white space, a row
    that was there before, text that does not end as a sentence does."""
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(last == "", BLANK).when(repeated, DUPLICATE).when(~last.isin(".", "!", "?"), CUT)


def repair_conversations(rows: DataFrame, spool_bytes: int = SPOOL_BYTES) -> DataFrame:
    """Edits of all conversations in ``rows`` (conv_id, turn, role, text): one row per edit, in order.

    ``place`` counts the edits of a conversation from 0. ``edit`` is K, R, D or I; ``turn``, ``was`` (role), ``fault`` are
    those of the row edited, null for I. ``role`` and ``text`` are what the repaired row has, null for D. Rows of a
    conversation stand together and in order within a partition.

    Rows go by turn, null first, then role and text. Null roles and texts are empty; a null conversation is one of its
    own. Rows whose role and text are those of an earlier row are duplicates, also of a row alike in all, and are
    deleted, as are blank ones. Any role by whose initial a row would fit may be kept. Further columns are ignored.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Which texts stand several times is found by counting, so that no task has to remember a conversation's texts.
    content = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    marked = rows.withColumn("content", content).withColumn("at", turn)
    several = marked.groupBy("conv_id", "content").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several = several.select(F.col("conv_id").alias("of"), F.col("content").alias("again"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("content") == F.col("again"))
    later = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    fault = first_fault(F.col("text"), later).alias("fault")
    ready = marked.join(several, same, "left").select("conv_id", "turn", "role", "text", fault)
    placed = ready.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    kinds = {"kind": rows.schema["conv_id"].dataType.simpleString(), "turn": rows.schema["turn"].dataType.simpleString()}
    return placed.mapInArrow(lambda batches: _repaired(batches, spool_bytes), _REPAIRED.format(**kinds))


def _repaired(batches, spool_bytes: int) -> Iterator[pa.RecordBatch]:
    current, repair, held, before = object(), None, None, None
    for batch in batches:
        columns = [batch.column(i) for i in range(5)]
        ids, turns, roles, texts, faults = (c.to_pylist() for c in columns)
        first = 0
        for i in range(batch.num_rows):
            if ids[i] != current or repair is None:
                if repair is not None:
                    held.add(_with_faults(batch, first, i, faults))
                    yield from _handed_out(repair, held)
                current, repair, held, before, first = ids[i], Repair(spool_bytes), Rows(spool_bytes), None, i
            row = (turns[i], roles[i], texts[i])
            if row == before and faults[i] != BLANK:
                faults[i] = DUPLICATE  # alike in turn too: right behind the first of them
            before = row
            repair.add(roles[i][:1], faults[i])
        if repair is not None:
            held.add(_with_faults(batch, first, batch.num_rows, faults))
    if repair is not None:
        yield from _handed_out(repair, held)


def _with_faults(batch: pa.RecordBatch, first: int, end: int, faults: list) -> pa.RecordBatch:
    part = batch.slice(first, end - first)
    return pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(faults[first:end], pa.string())], names=["conv_id", "turn", "role", "text", "fault"])


def _handed_out(repair: Repair, held: Rows) -> Iterator[pa.RecordBatch]:
    _, ending, file = repair.finish()
    path, place, conv_id, kinds = repair.path(file), 0, None, None
    for batch in held.read():
        kinds = batch.schema.field("conv_id").type, batch.schema.field("turn").type
        for start in range(0, batch.num_rows, OUT_ROWS):
            part = batch.slice(start, OUT_ROWS).to_pylist()
            out = []
            for row in part:
                conv_id = row["conv_id"]
                _, letter, role, _, inserted, _ = next(path)
                out += [("I", None, None, None, _ROLES[r], "") for r in inserted]
                kept = {"K": row["role"], "R": _ROLES.get(role), "D": None}[letter]
                out.append((letter, row["turn"], row["role"], row["fault"], kept, None if letter == "D" else row["text"]))
            yield _edits(conv_id, place, out, kinds)
            place += len(out)
    if ending:
        yield _edits(conv_id, place, [("I", None, None, None, _ROLES[r], "") for r in ending], kinds)


def _edits(conv_id, place: int, out: list[tuple], kinds) -> pa.RecordBatch:
    edit, turn, was, fault, role, text = zip(*out)
    n = len(out)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([conv_id] * n, kinds[0]), pa.array(range(place, place + n), pa.int64()), pa.array(edit), pa.array(turn, kinds[1]),
            *[pa.array(column, pa.string()) for column in (was, fault, role, text)],
        ],
        names=["conv_id", "place", "edit", "turn", "was", "fault", "role", "text"],
    )


_SUMMARY = """conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,
    repaired_sha256 string"""


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_conversations``, in the same tasks: turns missing between the first and the
    last, rows by fault, neighbours whose initials do not fit, cost and letters of the edits, and the digest of the
    repaired rows as ``role:text``, joined by line breaks."""
    return repaired.mapInArrow(_summed_up, _SUMMARY.format(kind=repaired.schema["conv_id"].dataType.simpleString()))


class Summary:
    def __init__(self):
        self.first = self.last = self.before = None
        self.distinct = self.illegal = self.cost = 0
        self.faults = {BLANK: 0, DUPLICATE: 0, CUT: 0}
        self.audit, self.digest, self.rows = bytearray(), sha256(), 0

    def add(self, edit: str, turn, was, fault, role, text) -> None:
        self.audit += edit.encode()
        self.cost += {"K": 0, "R": RETAG, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if fault == CUT and edit != "D":
                self.cost += TRUNCATED
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
            if turn is not None and turn != self.last:
                self.first, self.last = (turn if self.first is None else self.first), turn
                self.distinct += 1
        if edit != "D":
            self.digest.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
            self.rows += 1

    def result(self, conv_id) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (conv_id, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def _summed_up(batches) -> Iterator[pa.RecordBatch]:
    conv_id, summary, done, schema = None, None, [], None
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    for batch in batches:
        kinds = [batch.column(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
        schema = pa.schema(list(zip(names, kinds)))
        ids, _, *edits = (c.to_pylist() for c in batch.columns)
        for of, *edit in zip(ids, *edits):
            if summary is None or of != conv_id:
                if summary is not None:
                    done.append(summary.result(conv_id))
                conv_id, summary = of, Summary()
            summary.add(*edit)
        if len(done) >= OUT_ROWS:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], schema=schema)
            done = []
    if summary is not None:
        done.append(summary.result(conv_id))
        yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in done], schema=schema)
