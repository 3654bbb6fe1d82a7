import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pytest

from wardflow.llm import conversations
from wardflow.llm.conversations import BLANK

sys.setrecursionlimit(20_000)

ROWS = "conv_id long, turn long, role string, text string"


def hurt(rows):
    """The contract's damage, written anew."""
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def expected(rows):
    """One conversation's row, by trying every edit at every turn."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(BLANK)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def follows(last, role):
        return role[:1] == "s" and last == "" or role[:1] == "u" and last in ("", "s", "a") or role[:1] == "a" and last == "u"

    @lru_cache(None)
    def best(i, last, run):
        """(cost, audit, lines) of the rest; at most two inserts in a run are tried."""
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        moves = []
        if run < 2:
            moves += [(2, "I", i, who, (f"{who}:",), run + 1) for who in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            moves.append((3, "D", i + 1, None, (), 0))
            if faults[i] not in ("b", "d"):
                more = faults[i] == "t"
                moves.append((more, "K", i + 1, role, (f"{role}:{text}",), 0))
                moves += [(2 + more, "R", i + 1, who, (f"{who}:{text}",), 0) for who in ("user", "assistant")]
        for cost, letter, at, who, lines, n in moves:
            if who is None or follows(last, who):
                rest = best(at, last if who is None else who[:1], n)
                if rest:
                    ways.append((cost + rest[0], letter + rest[1], lines + rest[2]))
        return min(ways, default=None)

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == k for f in faults) for k in "bdt"],
        sum(p not in ("su", "ua", "au") for p in pairs),
        int(cost),
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def brute(original, rows):
    return sorted(((c, *expected([r[1:] for r in rows if r[0] == c])) for c in {r[0] for r in original}), key=repr)


def made_up(draw, convs, longest):
    texts = ["Fine.", "fine", "Well!", "", " \n", "why?\n ", "ok é.", None, "Tell me", "a\nb."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "usher", None]
    rows = []
    for c in range(convs):
        for t in range(draw.randint(0, longest)):
            turn = draw.choice([t, t, t, t, t + 3, None])
            rows.append((c, turn, draw.choice(roles[:4] if draw.random() < 0.7 else roles), draw.choice(texts) if draw.random() < 0.5 else f"{draw.random()}."))
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_trying_every_edit(spark):
    rows = made_up(random.Random(3), 150, 9) + [(None, 0, "user", "Hm."), (None, 1, "user", None), (2**60 + 1, 5, "assistant", "x")]
    table = spark.createDataFrame(rows, ROWS)
    damaged = conversations.damage(table)
    assert sorted(map(repr, hurt(rows))) == sorted(repr(tuple(r)) for r in damaged.collect())
    assert got(conversations.report(spark, table, damaged)) == brute(rows, hurt(rows))


def test_conversations_over_many_slices(spark):
    """Two long conversations, each over several range partitions."""
    draw = random.Random(8)
    rows = [(c, t, draw.choice(["user", "assistant", "tool"]), f"{draw.random()}" + draw.choice(["", ".", "."])) for c in (1, 2) for t in range(400)]
    rows += [(3, t, "user", "same.") for t in range(150)] + [(4, t, None, " ") for t in range(60)]
    table = spark.createDataFrame(rows, ROWS).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = table.select(conversations.key_of(table["conv_id"]).alias("key"), "turn", "role", "text").selectExpr("*", "monotonically_increasing_id() place")
        pieces = conversations.pieces_of(conversations.in_slices(spark, conversations.with_faults(turns)))
        assert pieces.where("head < tail").select("key").distinct().count() >= 2
        found = got(conversations.report(spark, table, table))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == brute(rows, [(c, t, " " if r is None else r, x) for c, t, r, x in rows])


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 17])
def test_blocks_and_transfers_agree(size):
    draw = random.Random(size)
    initials = "".join(draw.choice("sua?") for _ in range(size))
    faults = "".join(draw.choice("..tbd") for _ in range(size))
    whole = conversations.backward(conversations.ENDED, initials, faults)
    assert whole == conversations.through(conversations.transfer(initials, faults), conversations.ENDED)
    block, marks = conversations.checkpoints(conversations.ENDED, initials, faults)
    assert len(marks) <= size**0.5 + 3 and block <= max(1, size**0.5)
    for state in range(4):
        audit, end, cost = conversations.walk(state, conversations.ENDED, initials, faults)
        spent = sum({"D": 3, "I": 2, "R": 2, "K": 0}[e] for e in audit + conversations.closing(end))
        kept = [e for e in audit if e != "I"]
        assert cost == whole[state] == spent + sum(f == "t" and e != "D" for f, e in zip(faults, kept))


def test_lines_are_the_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well?"), (1, 2, "assistant", "Yes."), (2, 0, "system", "Be."), (2, 1, "assistant", "Go.")]
    table = spark.createDataFrame([(*r, "own", "own") for r in rows], f"{ROWS}, key string, slice string")
    found, lines = conversations.repair(spark, table)
    assert {r.conv_id: (r.audit, r.cost) for r in found.collect()} == {1: ("KIKK", 2), 2: ("KIK", 2)}
    kept = [(r.role, r.text) for r in sorted(lines.collect(), key=lambda r: (r.key, r.slice, r.number))]
    assert kept == [("user", "Hi."), ("assistant", ""), ("user", "Well?"), ("assistant", "Yes."), ("system", "Be."), ("user", ""), ("assistant", "Go.")]


def test_empty_table(spark):
    none = spark.createDataFrame([], ROWS)
    assert conversations.report(spark, none, conversations.damage(none)).count() == 0
