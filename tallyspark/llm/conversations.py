"""Repair of the turn structure of conversations, at the least cost of edits.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``. Its rows, by turn,
are kept (0), given the role that is due (3) or deleted (4), and empty messages of the role
that is due are inserted (3). Blank and repeated rows must go; a truncated row that stays
costs 3 more. Of the cheapest edits, those whose initials come first in ASCII are taken.

Rows are repartitioned by conversation and sorted by turn, and a task streams over them. What
it carries from batch to batch is the state of a dynamic program: for each of the four places
in the pattern (nothing yet, after s, after u, after a) the least cost, the order of the
edits' initials among the four, and the running SHA-256 of the repaired text. Texts are not
held. Right after a row no sequence of initials begins another (both have one letter other
than I for each row), so their order is that of their predecessors, and then of the letters
added. The initials themselves are read from backpointers, four bytes a row, which go to an
anonymous scratch file of the task beyond ``SPILL`` bytes; it ends with the task, and a task
that is lost starts anew from the shuffle. Repeated rows are found before, by a join on
conversation, role and digest, so that no task keeps the texts it has seen.

Nulls: a null role or text is one space, so the row is blank; null turns come first and do
not count as turns; rows with a null conversation are one conversation. Rows of one turn are
taken by role, then text. Empty texts are blank. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# bytes of backpointers held in memory
SPILL = 1 << 22
OUT_ROWS = 4096

# places in the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a
_DUE = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_NEVER = 1 << 60
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_LETTERS = "DKR"
_NONE = 255

SUMMARY = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
MESSAGES = "conv_id long, position long, role string, text string"


@lru_cache(maxsize=None)
def _step(costs: tuple, order: tuple, initial: str, fault: int) -> tuple:
    """One row: (least cost, costs above it, order, moves) of the four places.

    A move is (place before, messages inserted, letter). Costs above the least are bounded,
    so there are few different steps.
    """
    best: list = [None] * 4
    for before in range(4):
        if costs[before] >= _NEVER:
            continue
        place, cost = before, costs[before]
        for inserted in range(3):
            options = [("D", place, DELETE)]
            if fault not in (_BLANK, _DUPLICATE):
                more = TRUNCATED if fault == _TRUNCATED else 0
                options.append(("R", _DUE[place], REROLE + more))
                if place in _KEPT.get(initial, {}):
                    options.append(("K", _KEPT[initial][place], KEEP + more))
            for letter, after, price in options:
                found = (cost + price, order[before], "I" * inserted + letter, (before, inserted, letter))
                if best[after] is None or found[:3] < best[after][:3]:
                    best[after] = found
            place, cost = _DUE[place], cost + INSERT
    # what follows nothing yet, or a lone s, can follow an a at little more
    if best[3]:
        if best[0] and best[0][0] > best[3][0] + DELETE:
            best[0] = None
        if best[1] and best[1][0] > best[3][0]:
            best[1] = None
    least = min(b[0] for b in best if b)
    ranked = sorted((b[1:3], p) for p, b in enumerate(best) if b)
    places = {p: i for i, (_, p) in enumerate(ranked)}
    return (
        least,
        tuple(b[0] - least if b else _NEVER for b in best),
        tuple(places.get(p, 0) for p in range(4)),
        tuple(b[3] if b else None for b in best),
        bytes(b[3][0] | b[3][1] << 2 | _LETTERS.index(b[3][2]) << 4 if b else _NONE for b in best),
    )


class _Trail:
    """Backpointers of one conversation, in a scratch file beyond ``limit`` bytes."""

    def __init__(self, limit: int):
        self.limit, self.held, self.file = limit, bytearray(), None

    def add(self, codes: bytes) -> None:
        self.held += codes
        if len(self.held) >= self.limit:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held.clear()

    def back(self) -> Iterator[bytes]:
        """The parts, last first."""
        yield bytes(self.held)
        if self.file is not None:
            at = self.file.tell()
            while at:
                size = min(at, self.limit & ~3 or 4)
                at -= size
                self.file.seek(at)
                yield self.file.read(size)
            self.file.close()

    def letters(self, place: int, inserted: int) -> str:
        """The initials of the edits that lead to ``place`` and the insertions after the last row."""
        out = bytearray(b"I" * inserted)
        for part in self.back():
            for at in range(len(part) - 4, -1, -4):
                code = part[at + place]
                out.append(ord(_LETTERS[code >> 4]))
                out += b"I" * (code >> 2 & 3)
                place = code & 3
        out.reverse()
        return out.decode()


class Conversation:
    """The dynamic program over the rows of one conversation, given in order."""

    def __init__(self, spill: int = SPILL):
        self.base, self.costs, self.order = 0, (0, _NEVER, _NEVER, _NEVER), (0, 0, 0, 0)
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.trail = _Trail(spill)
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = self.initial = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last = turn if self.first is None else self.first, turn
            self.turns += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        least, self.costs, self.order, moves, codes = _step(self.costs, self.order, initial if initial in _KEPT else "", fault)
        self.base += least
        self.trail.add(codes)
        message = None
        hashes: list = [None] * 4
        for place, move in enumerate(moves):
            if move is None:
                continue
            before, inserted, letter = move
            digest = self.hashes[before]
            if inserted or letter != "D":
                digest, before = _with_inserted(digest.copy(), before, inserted)
                if letter != "D":
                    if message is None:
                        message = f":{text}".encode()
                    digest.update((("\n" if before else "") + (role if letter == "K" else _ROLE[place])).encode())
                    digest.update(message)
            hashes[place] = digest
        self.hashes = hashes

    def close(self) -> tuple:
        """Gaps, blank, duplicate, truncated and illegal rows, cost, initials and SHA-256."""
        ends = []
        for place, cost in enumerate(self.costs):
            at = place
            for inserted in range(3):
                if cost < _NEVER and at in (0, 3):
                    ends.append((cost + INSERT * inserted, self.order[place], inserted, place))
                at = _DUE[at]
        cost, _, inserted, place = min(ends)
        digest, _ = _with_inserted(self.hashes[place].copy(), place, inserted)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        audit = self.trail.letters(place, inserted)
        return (gaps, *self.faults[1:], self.illegal, self.base + cost, audit, digest.hexdigest())


def _with_inserted(digest, place: int, count: int) -> tuple:
    for _ in range(count):
        digest.update((("\n" if place else "") + _ROLE[_DUE[place]] + ":").encode())
        place = _DUE[place]
    return digest, place


def ordered(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Thin rows without nulls: conv, no_conv, turn, no_turn, role, text."""
    conv, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    zero = F.lit(0).cast("long")
    return conversations.select(
        F.coalesce(conv, zero).alias("conv"),
        conv.isNull().alias("no_conv"),
        F.coalesce(turn, zero).alias("turn"),
        turn.isNull().alias("no_turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )


def _streamed(rows: DataFrame, *leading: str) -> DataFrame:
    """Secondary sort: a conversation's rows in one task, one after the other."""
    order = ["no_conv", "conv", *leading, F.desc("no_turn"), "turn", "role", "text"]
    return rows.repartition("no_conv", "conv").sortWithinPartitions(*order)


def audits(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    spill: int = SPILL,
) -> DataFrame:
    """One row per conversation: its faults, the cost and initials of its edits, the SHA-256.

    ``audit`` has an initial for each edit in order: Keep, Rerole, Delete, Insert. The hash is
    that of the repaired messages as ``role:text``, joined by newlines.
    """
    rows = ordered(conversations, conv_col, turn_col, role_col, text_col).withColumn("digest", F.sha2("text", 256))
    key = ["no_conv", "conv", "role", "digest"]
    place = F.struct((~F.col("no_turn")).alias("later"), "turn")
    repeated = (
        rows.groupBy(*key)
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")
        .select(*key, "first")
    )
    marked = rows.join(repeated, key, "left").select(
        "no_conv",
        "conv",
        "no_turn",
        "turn",
        "role",
        "text",
        F.col("first").isNotNull().alias("repeated"),
        F.coalesce(place > F.col("first"), F.lit(False)).alias("later"),
    )

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        current = state = before = None
        for batch in batches:
            stripped = batch["text"].str.strip(" \t\n\x0b\x0c\r")
            truncated = ~stripped.str[-1:].isin([".", "!", "?"])
            columns = [batch[c].tolist() for c in ("no_conv", "conv", "no_turn", "turn", "role", "text", "repeated", "later")]
            for no_conv, conv, no_turn, turn, role, text, again, later, blank, cut in zip(
                *columns, (stripped == "").tolist(), truncated.tolist()
            ):
                if current != (no_conv, conv):
                    if state is not None:
                        done.append((None if current[0] else current[1], *state.close()))
                    current, state, before = (no_conv, conv), Conversation(spill), None
                    if len(done) >= OUT_ROWS:
                        yield _summaries(done)
                        done = []
                row = (no_turn, turn, role, text) if again else None
                fault = _BLANK if blank else _DUPLICATE if later or (again and row == before) else _TRUNCATED if cut else _FINE
                before = row
                state.add(None if no_turn else turn, role, text, fault)
        if state is not None:
            done.append((None if current[0] else current[1], *state.close()))
        yield _summaries(done)

    return _streamed(marked).mapInPandas(repair, SUMMARY)


def _summaries(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[f.split()[0] for f in SUMMARY.split(", ")])
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


def repaired(
    conversations: DataFrame,
    audit: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, position, role, text): the messages after the edits of ``audits``.

    A task holds one conversation's initials, a byte for each edit.
    """
    rows = ordered(conversations, conv_col, turn_col, role_col, text_col).withColumn("kind", F.lit(1))
    edits = audit.select(
        F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv"),
        F.col("conv_id").isNull().alias("no_conv"),
        F.lit(0).cast("long").alias("turn"),
        F.lit(True).alias("no_turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(0).alias("kind"),
    )

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, letters, at, place, position = None, "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []

            def inserted() -> None:
                nonlocal at, place, position
                while letters[at : at + 1] == "I":
                    place, at, position = _DUE[place], at + 1, position + 1
                    out.append((conv, position - 1, _ROLE[place], ""))

            for no_conv, key, kind, role, text in zip(*[batch[c].tolist() for c in ("no_conv", "conv", "kind", "role", "text")]):
                if kind == 0:
                    conv, letters, at, place, position = None if no_conv else key, text, 0, 0, 0
                    inserted()
                    continue
                letter, at = letters[at], at + 1
                if letter != "D":
                    place = _DUE[place] if letter == "R" else _KEPT[role[:1]][place]
                    out.append((conv, position, _ROLE[place] if letter == "R" else role, text))
                    position += 1
                inserted()
            frame = pd.DataFrame(out, columns=["conv_id", "position", "role", "text"])
            yield frame.astype({"conv_id": "Int64", "position": np.int64})

    return _streamed(rows.unionByName(edits), "kind").mapInPandas(apply, MESSAGES)


def damaged(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    divisor: int = 20,
) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by the CRC of ``conv_id:turn``.

    A remainder of 0 drops the row, 1 empties its text, 2 takes out its stops, 3 repeats it,
    4 makes it the user's. Nulls are one space.
    """
    space = F.lit(" ")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), space)
    draw = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col))) % divisor
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(shown(text_col), "[.!?]", "")).otherwise(shown(text_col))
    rows = conversations.filter(draw != 0).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(draw == 4, "user").otherwise(shown(role_col)).alias("role"),
        text.alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def repair_report(conversations: DataFrame, rows: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """``audits`` of ``rows`` for every conversation of ``conversations``, also those without rows."""
    every = conversations.select(F.col(conv_col).cast("long").alias("own")).distinct()
    found = audits(rows)
    empty = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    joined = every.join(found, every["own"].eqNullSafe(found["conv_id"]), "left")
    return joined.select(F.col("own").alias("conv_id"), *[F.coalesce(c, e).alias(c) for c, e in empty.items()])
