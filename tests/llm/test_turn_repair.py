"""The repair of conversations against a search over all edits, written without prices."""

import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pytest

from spanlake.llm import turn_repair as tr

sys.setrecursionlimit(20_000)

SPACES = set("\t\n\v\f\r ")


def fault_list(rows):
    found, seen = [], set()
    for _, role, text in rows:
        solid = [c for c in text if c not in SPACES]
        if not solid:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, faults):
    """Cost, letters and repaired rows by plain recursion over (row, last initial)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def add(cost, letter, new, j, more):
            for role in [new]:
                state = last if role is None else role[:1]
                if role is not None and (not state or state not in legal[last]):
                    continue
                c, word, out = best(j, state, more)
                kept = () if role is None else ((role, rows[i][2] if letter in "KR" else ""),)
                ways.append((cost + c, letter + word, kept + out))

        if inserts < 3:
            for role in ("user", "assistant"):
                add(5, "I", role, i, inserts + 1)
        if i < len(rows):
            add(2, "D", None, i + 1, 0)
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                add(more, "K", rows[i][1], i + 1, 0)
                for role in ("user", "assistant"):
                    add(1 + more, "R", role, i + 1, 0)
        return min(ways, key=lambda w: w[:2]) if ways else (10**9, "~", ())

    return best(0, "", 0)


def expected(rows):
    """Row of the query for the rows of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = fault_list(rows)
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[1][:1] for r in rows]
    cost, audit, out = cheapest(rows, tuple(faults)) if rows else (0, "", ())
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def damage(rows):
    made = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        shown = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(shown.encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if what == 4:
            role = "user"
        made += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(what, 1)
    return made


SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault int, part string"


def conversations(seed, count):
    rng = random.Random(seed)
    texts = ["Yes.", "No?", "open", " . ", "", "\t\n", "é!", "é", "a b\n"]
    for conv in [None, *range(count)]:
        for turn in range(rng.choice([1, 2, 3, 5, 7])):
            turn = rng.choice([None, turn, turn, turn, turn + 2, 3 * turn])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "s"])
            text = rng.choice([*texts, None, f"{conv} {turn}."])
            yield conv, turn, role, text


def run(spark, rows, partitions=8):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    ids = spark.createDataFrame([(r[0],) for r in rows], "conv_id bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = tr.summaries(tr.repair(tr.damaged(df), ids=ids)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}


def test_random_conversations_equal_a_plain_search(spark):
    rows = list(conversations(1, 300))
    changed = damage(rows)
    found = run(spark, rows)
    assert set(found) == {r[0] for r in rows}
    for conv, made in found.items():
        assert made == expected([r[1:] for r in changed if r[0] == conv])


@pytest.mark.parametrize("partitions", [3, 40])
def test_conversation_cut_into_segments(spark, partitions):
    """One conversation holds nearly all rows, so each range has a segment of it."""
    rng = random.Random(partitions)
    roles = ["user", "assistant", "assistant", "tool", "system"]
    rows = [(5, i, rng.choice(roles), rng.choice(["Yes.", "open", f"{i}?", f"{i}", ""])) for i in range(150)]
    rows += [(6, 0, "user", "Hello."), (6, 1, "assistant", "Hi.")]
    changed = damage(rows)
    found = run(spark, rows, partitions)
    for conv in (5, 6):
        assert found[conv] == expected([r[1:] for r in changed if r[0] == conv])


def test_prices_equal_a_relaxation():
    """Prices of the auction against repeated relaxation, for all kinds and many layers behind."""
    rng = random.Random(3)
    kinds = [tr.Kind(i, f) for i in ("s", "u", "a", "t", "") for f in ("", "truncated", "blank", "duplicate")]
    for _ in range(2_000):
        after = tuple(rng.choice([None, *range(12)]) for _ in tr.STATES)
        kind = rng.choice(kinds)
        price = [10**6] * 4
        for _ in range(10):
            for s in tr.STATES:
                for arc in tr.arcs(kind, s):
                    to = price[arc.to] if arc.same_layer else after[arc.to]
                    price[s] = min(price[s], arc.cost + (10**6 if to is None else to))
        assert tr.settle(kind, after) == tuple(p if p < 10**6 else None for p in price)


def test_edits_of_a_conversation(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (1, 4, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    edits = [(r.at, r.edit, r.cost, r.role, r.text) for r in tr.repair(df).collect()]
    assert edits == [
        (0, "K", 0, "system", "Be kind."), (1, "D", 2, None, None),
        (2, "K", 0, "user", "Well?"), (3, "K", 0, "assistant", "Yes."),
    ]


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert tr.summaries(tr.repair(tr.damaged(df), ids=df)).collect() == []
    ids = spark.createDataFrame([(1,), (1,), (None,)], "conv_id bigint")
    found = tr.summaries(tr.repair(df, ids=ids)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, found), key=str) == [(1, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]
