"""Repair of the structure of conversations by secondary-sorted streaming.

Rows are dealt out by conversation and sorted by turn; ``mapInPandas`` reads them as a stream and carries the state of
a dynamic program across Arrow batches.  The program finds the cheapest edits (keep, change the role, delete, insert)
after which a conversation is ``(s?(ua)+)?`` by the initials of its roles.  Its state are the costs of the four places
in that pattern and the order of their edits so far; only few such states exist relative to the cheapest place, so a
step is looked up once known.  A row leaves one number of backpointers; those of long conversations, and their texts,
go to the task's own spill file.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What edits cost.
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
#: Rows of a conversation that are held in memory, and bytes of pickled rows; more of them are spilled.
IN_MEMORY, SPILL_BYTES = 1 << 18, 16 << 20

#: Places in the pattern: before anything, after s, after u, after a; and where an initial leads from each.
START, SYSTEM, ASKED, ANSWERED = range(4)
NEXT = {"s": (SYSTEM, None, None, None), "u": (ASKED, ASKED, None, ASKED), "a": (None, None, ANSWERED, None)}
#: What may be inserted, or a role changed to, at each place: the role and where it leads.
WRITTEN = ((USER, ASKED), (USER, ASKED), (ASSISTANT, ANSWERED), (USER, ASKED))
LETTERS = "DKR"  # in the order of their bytes, with I for an insertion between D and K
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
_FAR = 1 << 60


def _blocks(initial: str, fault: int) -> list[tuple[str, int, int, int, int, int]]:
    """What one row can become from each place: edits (insertions, then D, K or R), place before and after, cost,
    number of insertions, number of the letter."""
    out = []
    for place in range(4):
        now, cost = place, 0
        for inserted in range(3):
            before = "I" * inserted
            out.append((before + "D", place, now, cost + DELETE, inserted, 0))
            if fault in (FINE, TRUNCATED):
                more = CUT_SHORT if fault == TRUNCATED else 0
                kept = NEXT[initial][now] if initial in NEXT else None
                if kept is not None:
                    out.append((before + "K", place, kept, cost + more, inserted, 1))
                out.append((before + "R", place, WRITTEN[now][1], cost + more + REROLE, inserted, 2))
            now, cost = WRITTEN[now][1], cost + INSERT
    return out


class Steps:
    """The dynamic program.  A state is, for each place, its cost above the least one (or far) and its rank by edits
    so far; blocks of edits end with D, K or R, so no list of edits begins another and ranks decide ties."""

    FIRST = ((0, _FAR, _FAR, _FAR), (0, 1, 2, 3))

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        self.blocks: dict[tuple[str, int], list] = {}

    def step(self, state: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
        """The next state, how much its least cost has risen, and the backpointers of all places in one number."""
        got = self.known.get((state, initial, fault))
        if got is None:
            blocks = self.blocks.get((initial, fault))
            if blocks is None:
                blocks = self.blocks[initial, fault] = _blocks(initial, fault)
            costs, ranks = state
            best = [None] * 4
            for edits, place, after, cost, inserted, letter in blocks:
                if costs[place] < _FAR:
                    way = (costs[place] + cost, ranks[place], edits, place | inserted << 2 | letter << 4)
                    if best[after] is None or way < best[after]:
                        best[after] = way
            rise = min(x[0] for x in best if x)
            order = sorted((p for p in range(4) if best[p]), key=lambda p: best[p][1:3])
            order += [p for p in range(4) if not best[p]]
            new = (tuple(x[0] - rise if x else _FAR for x in best), tuple(order.index(p) for p in range(4)))
            got = self.known[state, initial, fault] = (new, rise, sum(x[3] << 6 * p for p, x in enumerate(best) if x))
        return got

    @staticmethod
    def last(state: tuple) -> tuple[int, int, int]:
        """Where the cheapest conversation ends, its cost above the least place, and insertions after its last row."""
        costs, ranks = state
        after = (0, 2, 1, 0)
        cost, _, place = min((costs[p] + INSERT * after[p], ranks[p], p) for p in range(4))
        return place, cost, after[place]


def _spill_file():
    """A file of this task alone, without a name, beside the blocks that Spark spills."""
    folders = [x for x in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(x)]
    return tempfile.TemporaryFile(dir=folders[os.getpid() % len(folders)] if folders else None)


class _Pointers:
    """Backpointers, written in order and read from the last to the first."""

    def __init__(self):
        self.held, self.file, self.n = array("I"), None, 0

    def add(self, x: int) -> None:
        self.held.append(x)
        self.n += 1
        if len(self.held) >= IN_MEMORY:
            self.file = self.file or _spill_file()
            self.held.tofile(self.file)
            self.held = array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        at = self.file.tell() if self.file else 0
        while at:
            size = min(at, 4 * IN_MEMORY)
            at -= size
            self.file.seek(at)
            yield from reversed(array("I", self.file.read(size)))


class _Rows:
    """Roles and texts, written and read in order."""

    def __init__(self):
        self.held, self.size, self.file = [], 0, None

    def add(self, role: str, text: str) -> None:
        self.held.append((role, text))
        self.size += len(role) + len(text) + 64
        if self.size >= SPILL_BYTES:
            self.file = self.file or _spill_file()
            pickle.dump(self.held, self.file)
            self.held, self.size = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
        yield from self.held


class _Conversation:
    """One conversation as it streams by."""

    def __init__(self, name: str | None, steps: Steps):
        self.name, self.steps = name, steps
        self.state, self.cost = Steps.FIRST, 0
        self.pointers, self.rows = _Pointers(), _Rows()
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.initial: str | None = None
        self.least = self.most = None
        self.turns = 0

    def add(self, turn: int, timed: bool, role: str, text: str, fault: int) -> None:
        if timed:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        self.faults[fault] += 1
        self.state, rise, pointers = self.steps.step(self.state, initial, fault)
        self.cost += rise
        self.pointers.add(pointers)
        self.rows.add(role, text)

    def edits(self) -> tuple[bytearray, int, int]:
        """For each row its insertions and the number of its letter (in one byte); insertions at the end; the cost."""
        place, cost, after = Steps.last(self.state)
        out = bytearray(self.pointers.n)
        for i, x in zip(range(self.pointers.n - 1, -1, -1), self.pointers.backwards()):
            way = x >> 6 * place & 63
            out[i] = way >> 2
            place = way & 3
        return out, after, self.cost + cost

    def repaired(self, edits: bytearray, after: int) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of the repaired rows; deleted rows have the edit D."""
        place = START

        def write(edit: str, text: str) -> tuple[str, str, str]:
            nonlocal place
            role, place = WRITTEN[place]
            return edit, role, text

        for way, (role, text) in zip(edits, self.rows):
            for _ in range(way & 3):
                yield write("I", "")
            letter = LETTERS[way >> 2]
            if letter == "R":
                yield write("R", text)
            else:
                if letter == "K":
                    place = NEXT[role[:1]][place]
                yield letter, role, text
        for _ in range(after):
            yield write("I", "")

    def summary(self) -> tuple:
        edits, after, cost = self.edits()
        digest, first, audit = hashlib.sha256(), True, bytearray()
        for edit, role, text in self.repaired(edits, after):
            audit += edit.encode()
            if edit != "D":
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.name, gaps, *self.faults[1:], self.illegal, cost, audit.decode(), digest.hexdigest())


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``key, turn, role, text, present``: rows with one of five faults, by a checksum of conversation and turn; a
    dropped row isn't ``present``.  Nulls read as one space."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(key), F.lit(":"), plain(turn)).cast("binary")) % 20
    out = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{turn}`").alias("turn"), plain(role).alias("role"),
                      plain(text).alias("text"), kind.alias("kind"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
        F.col("text"))
    twice = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.select("key", "turn", F.when(F.col("kind") == 4, USER).otherwise(F.col("role")).alias("role"),
                      changed.alias("text"), (F.col("kind") != 0).alias("present"), twice.alias("copy")).drop("copy")


def _sorted(rows: DataFrame, key: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """Rows dealt out by conversation, sorted by turn (nulls first), then role and text, with the first fault of each.
    One shuffle: repeats are numbered within the same partitions."""
    out = rows.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))
    out = out.repartition("key")
    out = out.withColumn("nth", F.row_number().over(
        Window.partitionBy("key", "present", "role", "text").orderBy("turn")))
    end = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(end == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(
        F.right(end, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    out = out.sortWithinPartitions("key", "turn", "role", "text", "nth")
    return out.select(F.col("key").cast("string").alias("key"), F.coalesce("turn", F.lit(0)).alias("turn"),
                      F.col("turn").isNotNull().alias("timed"), "role", "text", "present",
                      fault.cast("int").alias("fault"))


def _conversations(frames: Iterator[pd.DataFrame]) -> Iterator[_Conversation]:
    """Whole conversations of a sorted stream; one is held at a time, across batches."""
    steps, now = Steps(), None
    for frame in frames:
        for key, turn, timed, role, text, present, fault in zip(
                *(frame[c].tolist() for c in ("key", "turn", "timed", "role", "text", "present", "fault"))):
            if now is None or key != now.name:
                if now is not None:
                    yield now
                now = _Conversation(key, steps)
            if present:
                now.add(turn, timed, role, text, fault)
    if now is not None:
        yield now


SUMMARY = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
           "repaired_sha256 string")
#: Rows, or characters, of an output batch.
_OUT_ROWS, _OUT_CHARS = 1000, 4 << 20


def _frames(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= _OUT_ROWS or size >= _OUT_CHARS:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def summarise(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
              present: Column | None = None) -> DataFrame:
    """One row per conversation: its key, ``gaps`` in its turns, rows that are ``blank``, ``duplicate`` or
    ``truncated``, ``illegal`` neighbours, the least ``cost`` of a repair, the edits that make it (``audit``, of the
    cheapest the least by bytes) and the SHA-256 of the repaired rows (``role:text``, joined by line feeds).

    Rows go by turn, null turns first, ties by role, then text.  A null role or text reads as one space; null keys are
    one conversation.  Rows that aren't ``present`` only name their conversation: one without any other has zeros, an
    empty audit and the hash of nothing.  Of equal rows the first isn't a duplicate.  An empty table gives no rows.
    """
    kind = rows.schema[key].dataType.simpleString()
    names = ["key", *(x.split()[0] for x in SUMMARY.split(", "))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames((x.summary() for x in _conversations(frames)), names)

    found = _sorted(rows, key, turn, role, text, present).mapInPandas(run, f"key string, {SUMMARY}")
    return found.select(F.col("key").cast(kind).alias(key), *names[1:])


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """The rows of the repaired conversations: key, ``seq`` (from 0), ``edit`` (I, K or R), ``role``, ``text``; what
    ``summarise`` says of orders and nulls holds.  A conversation that loses all its rows has none."""
    kind = rows.schema[key].dataType.simpleString()

    def kept(one: _Conversation) -> Iterator[tuple]:
        edits, after, _ = one.edits()
        stay = (x for x in one.repaired(edits, after) if x[0] != "D")
        return ((one.name, i, *x) for i, x in enumerate(stay))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _frames((x for one in _conversations(frames) for x in kept(one)),
                           ["key", "seq", "edit", "role", "text"])

    found = _sorted(rows, key, turn, role, text, None).mapInPandas(
        run, "key string, seq bigint, edit string, role string, text string")
    return found.select(F.col("key").cast(kind).alias(key), "seq", "edit", "role", "text")
