"""Conversation repair against brute force: every sequence of edits, spelled out."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import conversations as C
from tallyspark.llm.common import ship_package

SCHEMA = "conv_id long, turn long, role string, text string, cost int, position string"
SOUND = re.compile(r"(s?(ua)+)?")


@pytest.fixture(autouse=True)
def small_batches(spark):
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # conversations go on from batch to batch
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def fault_of(role, text, seen):
    if not text.strip(" \t\n\v\f\r"):
        return 1
    if (role, text) in seen:
        return 2
    return 0 if text.strip(" \t\n\v\f\r")[-1] in ".!?" else 3


def cheapest(rows):
    """(cost, audit, messages) over all edits, with whole strings at each step; rows are (role, text) in order."""
    seen, paths = set(), {("", 0): (0, "", [])}  # by the roles' initials so far, cut to what matters

    def reduced(roles):
        return ("", 0) if not roles else (roles[-1], len(roles) > 1)

    def put(found, cost, audit, messages):
        key = reduced([m[0][:1] for m in messages])
        if key not in found or (cost, audit) < found[key][:2]:
            found[key] = (cost, audit, messages)

    def sound_so_far(messages):
        return any(SOUND.fullmatch("".join(m[0][:1] for m in messages) + more) for more in ("", "a", "ua"))

    def with_inserts(paths):
        found = dict(paths)
        for _ in range(3):
            for cost, audit, messages in list(found.values()):
                for role in ("user", "assistant"):
                    if sound_so_far(messages + [(role, "")]):
                        put(found, cost + 3, audit + "I", messages + [(role, "")])
        return found

    for role, text in rows:
        fault = fault_of(role, text, seen)
        seen.add((role, text))
        found = {}
        for cost, audit, messages in with_inserts(paths).values():
            put(found, cost + 4, audit + "D", messages)
            if fault in (1, 2):
                continue
            for letter, price, given_role in [("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")]:
                if len(given_role) and sound_so_far(messages + [(given_role, text)]):
                    put(found, cost + price + (3 if fault == 3 else 0), audit + letter, messages + [(given_role, text)])
        paths = found
    ends = [p for p in with_inserts(paths).values() if SOUND.fullmatch("".join(m[0][:1] for m in p[2]))]
    return min(ends, key=lambda p: p[:2])


def said(messages):
    return "\n".join(f"{r}:{t}" for r, t in messages)


def expected(rows):
    """The row of ``audits`` for rows of (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), [0] * 4
    for _, role, text in rows:
        faults[fault_of(role, text, seen)] += 1
        seen.add((role, text))
    roles = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, messages = cheapest([r[1:] for r in rows])
    return (gaps, *faults[1:], illegal, cost, audit, hashlib.sha256(said(messages).encode()).hexdigest()), messages


ROWS = st.lists(
    st.tuples(st.sampled_from(["system", "user", "assistant", "uncle", "", "tool"]), st.sampled_from(["a.", "b", " ", "", "c!", "d?\n"])),
    max_size=9,
)


@settings(max_examples=300, deadline=None)
@given(ROWS, st.sampled_from([4, 12, 1 << 20]))
def test_state_equals_all_edits(rows, spill):
    state, seen = C.Conversation(spill), set()
    for i, (role, text) in enumerate(rows):
        state.add(i, role, text, fault_of(role, text, seen))
        seen.add((role, text))
    cost, audit, messages = cheapest(rows)
    assert state.close()[5:] == (cost, audit, hashlib.sha256(said(messages).encode()).hexdigest())


def conversations(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi there."), (1, 2, "assistant", "Hello"), (1, 4, "user", None),
        (2, 3, "assistant", "late."), (2, None, "user", "no turn."), (2, 3, "assistant", "late."), (2, 9, None, "who?"),
        (3, 1, "user", ""), (None, 1, "user", "lost."), (None, 2, "user", "lost."),
        (4, 5, "user", "x" * 5_000_000), (4, 6, "assistant", "ok."), (9, 1, "user", "same."), (9, 1, "assistant", "turn."),
    ]
    long = [(7, t, ("user", "assistant")[t % 2], f"turn {t % 300}.") for t in range(900)]
    return spark.createDataFrame([(*r, 5, "x") for r in rows + long], SCHEMA)


def by_conversation(rows):
    found = {}
    for r in rows:
        found.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    return found


def test_audits_and_repaired_messages(spark):
    table = conversations(spark)
    audit = C.audits(table, spill=64)
    got = {r["conv_id"]: tuple(r)[1:] for r in audit.collect()}
    want = {k: expected(v) for k, v in by_conversation(table.collect()).items()}
    assert got == {k: v[0] for k, v in want.items()}
    messages = {}
    for r in sorted(C.repaired(table, audit).collect(), key=lambda r: r["position"]):
        messages.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert messages == {k: v[1] for k, v in want.items() if v[1]}


def damaged(rows):
    show = lambda v: " " if v is None else str(v)
    for conv, turn, role, text, *_ in rows:
        draw, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        for _ in range((0, 2)[draw == 3] or draw != 0):
            yield {"conv_id": conv, "turn": turn, "role": "user" if draw == 4 else role, "text": text}


def test_report_of_damaged_rows(spark):
    table = conversations(spark)
    got = {r["conv_id"]: tuple(r)[1:] for r in C.repair_report(table, C.damaged(table)).collect()}
    rows = by_conversation(damaged(table.collect()))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    every = {r["conv_id"] for r in table.select("conv_id").collect()}
    assert got == {k: expected(rows[k])[0] if k in rows else none for k in every}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair_report(none, C.damaged(none)).count() == 0
    assert C.repaired(none, C.audits(none)).count() == 0
