"""Structure repair of conversations: the cheapest edits that make roles alternate.

A repaired conversation is empty or has an optional system turn first and then
user and assistant turns in turn, the assistant's last. Keeping a turn costs 0,
giving it the other role 2, deleting it 3, inserting an empty turn 2, keeping a
truncated turn 1 more; blank turns and duplicates must be deleted. Of the
cheapest edits those count whose initials (D, I, K, R), in order, are least.

The cost of the rest of a conversation depends only on which of four roles was
written last (none, system, user, assistant). So the table of costs is computed
backward, and edits are read off forward. Only the vectors at checkpoints are
stored, one every square root of the turns, and each block is recomputed from
its checkpoint when the walk enters it.

A conversation may hold any share of all rows, so no task needs a whole one.
Turns (without their texts) are cut by range into slices; the part of a
conversation in a slice is a piece. A conversation that spans slices has a
checkpoint at each slice's end: every piece gives the 4 x 4 costs from its first
to its last role, from which the vectors at the slices' ends follow backward.
Each later piece is walked from each role it may be entered with, and the roles
follow forward. There are at most two pieces a slice of such conversations. The
digest of a repaired conversation reads its lines in order, one at a time.

Defined cases: a null role or text counts as one space; turns are in order of
their number, nulls first, equal ones by role and then by the text's MD5 digest;
equal rows are duplicates but for the first; a role counts by its initial, and
one that is not s, u or a cannot be kept; a null id is a conversation like any
other; extra columns are ignored; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import keep

#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: What was written last: nothing, system, user, assistant; and who comes next.
STATES = " sua"
START = 0
NEXT = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: No way to end from here.
NEVER = 1 << 60


def initial(role: Column) -> Column:
    """``s``, ``u`` or ``a`` as a role begins, ``?`` for any other."""
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("?")


def key_of(conv_id: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.to_json(F.struct(conv_id.alias("c")))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the contract's faults put in by crc32(``conv_id:turn``) % 20.

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it,
    4 sets its role to user. Nulls of role, text and the checksum's parts are
    one space.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat(told[0], F.lit(":"), told[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code"))
        .where("code <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def with_faults(turns: DataFrame) -> DataFrame:
    """(place, key, turn, initial, role, digest, fault) of kept turns, without their texts.

    The first fault of a turn counts: ``b`` blank, ``d`` duplicate of an earlier
    turn, ``t`` truncated, else ``.``.
    """
    end = F.rtrim("text", F.lit(BLANK))
    slim = turns.select(
        "place",
        "key",
        "turn",
        "role",
        initial(F.col("role")).alias("initial"),
        F.md5("text").alias("digest"),
        F.substring(end, -1, 1).alias("last"),
    )
    firsts = (
        slim.where("last <> ''")
        .groupBy("key", "role", "digest")
        .agg(F.min(F.struct("turn", "place")).alias("m"))
        .select(F.col("m.place").alias("place"), F.lit(True).alias("first"))
    )
    fault = (
        F.when(F.col("last") == "", "b")
        .when(F.col("first").isNull(), "d")
        .when(~F.col("last").isin(".", "!", "?"), "t")
        .otherwise(".")
    )
    return slim.join(firsts, "place", "left").withColumn("fault", fault).drop("last", "first")


def in_slices(spark: SparkSession, faulty: DataFrame) -> DataFrame:
    """Turns in order, with the number of their slice and place in it, written."""
    order = ["key", "turn", "role", "digest", "place"]
    cut = (
        faulty.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("key", "turn", "place", "initial", "fault", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("seq"))
    )
    return keep(spark, cut, "slices")[0]


def pieces_of(sliced: DataFrame) -> DataFrame:
    """(key, slice, head, tail, initials, faults, places): a conversation's turns in a slice.

    ``head`` and ``tail`` are the conversation's first and last slice.
    """
    whole = Window.partitionBy("key")
    return (
        sliced.groupBy("key", "slice")
        .agg(F.array_sort(F.collect_list(F.struct("seq", "place", "initial", "fault"))).alias("t"))
        .select(
            "key",
            "slice",
            F.array_join("t.initial", "").alias("initials"),
            F.array_join("t.fault", "").alias("faults"),
            F.col("t.place").alias("places"),
        )
        .withColumns({"head": F.min("slice").over(whole), "tail": F.max("slice").over(whole)})
    )


Vector = tuple[int, int, int, int]


def with_inserts(v: Vector) -> Vector:
    """Costs when turns may be inserted first: two at most are of use."""
    return tuple(min(v[s], INSERT + v[NEXT[s]], 2 * INSERT + v[NEXT[NEXT[s]]]) for s in range(4))


#: Nothing left to read: fine at the start and after an assistant.
ENDED = with_inserts((0, NEVER, NEVER, 0))


def taken(state: int, role: str) -> int | None:
    """The state after keeping a turn of this initial, None where it may not stand."""
    if state == START and role == "s":
        return 1
    return NEXT[state] if STATES[NEXT[state]] == role else None


#: State after keeping a turn, by initial and state.
KEPT = {role: tuple(taken(s, role) for s in range(4)) for role in "sua?"}


def before(v: Vector, role: str, fault: str) -> Vector:
    """Costs before a turn from those after it."""
    if fault in "bd":
        return v[0] + DELETE, v[1] + DELETE, v[2] + DELETE, v[3] + DELETE
    more = TRUNCATED if fault == "t" else 0
    own = []
    for s, to in enumerate(KEPT[role]):
        keep_it = v[to] if to is not None else NEVER
        own.append(min(DELETE + v[s], more + min(keep_it, REROLE + v[NEXT[s]])))
    return with_inserts(tuple(own))


def backward(v: Vector, initials: str, faults: str) -> Vector:
    for role, fault in zip(reversed(initials), reversed(faults)):
        v = before(v, role, fault)
    return v


def transfer(initials: str, faults: str) -> list[int]:
    """Least cost from each state before the turns to each state after them, 16 numbers."""
    columns = [backward(tuple(0 if s == t else NEVER for s in range(4)), initials, faults) for t in range(4)]
    return [columns[t][s] for s in range(4) for t in range(4)]


def through(matrix: list[int], v: Vector) -> Vector:
    return tuple(min(matrix[4 * s + t] + v[t] for t in range(4)) for s in range(4))


def checkpoints(v: Vector, initials: str, faults: str) -> tuple[int, list[Vector]]:
    """Block length and the vectors at the end of every block, the first block's first."""
    block = max(1, isqrt(len(initials)))
    starts = range(0, len(initials), block)
    found = []
    for at in reversed(starts):
        found.append(v)
        v = backward(v, initials[at : at + block], faults[at : at + block])
    return block, found[::-1]


def walk(state: int, v: Vector, initials: str, faults: str) -> tuple[str, int, int]:
    """The least of the cheapest edits from ``state``: (audit, state after, cost).

    ``v`` are the costs of what follows; edits there are not part of the audit.
    """
    block, marks = checkpoints(v, initials, faults)
    audit: list[str] = []
    cost = None
    for b, after in enumerate(marks):
        rows = list(zip(initials[b * block : (b + 1) * block], faults[b * block : (b + 1) * block]))
        table = [after]
        for role, fault in reversed(rows):
            table.append(before(table[-1], role, fault))
        table.reverse()
        if cost is None:
            cost = table[0][state]
        for i, (role, fault) in enumerate(rows):
            here, there = table[i], table[i + 1]
            more = TRUNCATED if fault == "t" else 0
            while True:
                left, to = here[state], KEPT[role][state]
                if DELETE + there[state] == left:
                    audit.append("D")
                    break
                if fault not in "bd" and INSERT + here[NEXT[state]] == left:
                    audit.append("I")
                    state = NEXT[state]
                    continue
                if to is not None and more + there[to] == left:
                    audit.append("K")
                    state = to
                else:
                    audit.append("R")
                    state = NEXT[state]
                break
    return "".join(audit), state, v[state] if cost is None else cost


def closing(state: int) -> str:
    """The inserts after the last turn."""
    return "I" * (ENDED[state] // INSERT)


def _transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [transfer(i, f) for i, f in zip(batch["initials"], batch["faults"])]
        yield pd.DataFrame({"key": batch["key"], "slice": batch["slice"], "matrix": found})


def _exits(pieces: pd.DataFrame) -> pd.DataFrame:
    """The costs after each of a conversation's pieces."""
    pieces = pieces.sort_values("slice", ascending=False)
    v, found = ENDED, []
    for matrix in pieces["matrix"]:
        found.append(list(v))
        v = through(list(matrix), v)
    return pd.DataFrame({"key": pieces["key"], "slice": pieces["slice"], "exit": found})


def _walks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each piece walked from the states it may be entered with (the first one: only the start)."""
    for batch in batches:
        rows = []
        for key, at, head, tail, initials, faults, end in zip(*(batch[c] for c in ("key", "slice", "head", "tail", "initials", "faults", "exit"))):
            v = ENDED if end is None else tuple(int(x) for x in end)
            ways = [walk(s, v, initials, faults) for s in range(1 if at == head else 4)]
            audits = [a + (closing(s) if at == tail else "") for a, s, _ in ways]
            rows.append((key, at, audits, [s for _, s, _ in ways], ways[0][2] if at == head else 0))
        yield pd.DataFrame(rows, columns=["key", "slice", "audits", "states", "cost"])


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state that each of a conversation's pieces is entered with."""
    pieces = pieces.sort_values("slice")
    state, found = START, []
    for states in pieces["states"]:
        found.append(state)
        state = int(states[state])
    return pd.DataFrame({"key": pieces["key"], "slice": pieces["slice"], "entry": found})


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each edit of a piece; ``role`` is null where the turn keeps its own."""
    for batch in batches:
        rows = []
        for key, at, state, audit, initials, places in zip(*(batch[c] for c in ("key", "slice", "entry", "audit", "initials", "places"))):
            turn = 0
            for number, edit in enumerate(audit):
                place, role = None if edit == "I" else int(places[turn]), None
                if edit == "K":
                    state = KEPT[initials[turn]][state]
                elif edit != "D":
                    state = NEXT[state]
                    role = ROLES[state]
                turn += edit != "I"
                rows.append((key, at, number, place, edit, role))
        out = pd.DataFrame(rows, columns=["key", "slice", "number", "place", "edit", "role"])
        yield out.astype({"place": "Int64"})


def repair(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts and edits of every conversation, and the turns of the repaired ones.

    The first table has one row a conversation: key, conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit. The second has one row an edit
    that leaves a turn: key, slice, number (their order), edit, role, text.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    numbered = conversations.select(key_of(F.col("conv_id")).alias("key"), "conv_id", "turn", role, text, F.monotonically_increasing_id().alias("place"))
    turns, _ = keep(spark, numbered, "turns")
    sliced = in_slices(spark, with_faults(turns))
    pieces, _ = keep(spark, pieces_of(sliced), "pieces")

    cut = pieces.where("head < tail")
    transfers = cut.select("key", "slice", "initials", "faults").mapInPandas(_transfers, "key string, slice int, matrix array<bigint>")
    exits = transfers.groupBy("key").applyInPandas(_exits, "key string, slice int, exit array<bigint>")
    walked = pieces.drop("places").join(exits, ["key", "slice"], "left").mapInPandas(
        _walks, "key string, slice int, audits array<string>, states array<int>, cost long"
    )
    walked, _ = keep(spark, walked, "walks")
    several = walked.join(cut.select("key", "slice"), ["key", "slice"], "left_semi").select("key", "slice", "states")
    entries = several.groupBy("key").applyInPandas(_entries, "key string, slice int, entry int")
    entry = F.coalesce("entry", F.lit(START))
    edited = (
        pieces.join(walked, ["key", "slice"])
        .join(entries, ["key", "slice"], "left")
        .select("key", "slice", "initials", "places", "cost", entry.alias("entry"), F.get("audits", entry).alias("audit"))
    )
    edited, _ = keep(spark, edited, "edits")
    return _summary(turns, sliced, edited), _repaired(turns, edited)


def _summary(turns: DataFrame, sliced: DataFrame, edited: DataFrame) -> DataFrame:
    counts = sliced.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.count_if(F.col("fault") == "b").alias("blank"),
        F.count_if(F.col("fault") == "d").alias("duplicate"),
        F.count_if(F.col("fault") == "t").alias("truncated"),
    )
    # Legal neighbours within pieces, and across the ends of a piece and the next.
    legal = F.length("initials") - F.length(F.regexp_replace("initials", "(?<=u)a|(?<=[sa])u", ""))
    parts = edited.groupBy("key").agg(
        F.sum(F.length("initials")).alias("n"),
        F.sum(legal).alias("legal"),
        F.sum("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("slice", "audit", F.substring("initials", 1, 1).alias("first"), F.substring("initials", -1, 1).alias("last")))).alias("p"),
    )
    meets = F.size(F.filter(F.sequence(F.lit(1), F.size("p")), lambda i: F.concat(F.get(F.col("p.last"), i - 1), F.coalesce(F.get(F.col("p.first"), i), F.lit("."))).isin("su", "ua", "au")))
    named = turns.select("key", "conv_id").distinct()
    return (
        named.join(counts, "key")
        .join(parts, "key")
        .select(
            "key",
            "conv_id",
            "gaps",
            "blank",
            "duplicate",
            "truncated",
            (F.col("n") - 1 - F.col("legal") - meets).cast("long").alias("illegal"),
            "cost",
            F.array_join("p.audit", "").alias("audit"),
        )
    )


def _repaired(turns: DataFrame, edited: DataFrame) -> DataFrame:
    edits = edited.select("key", "slice", "entry", "audit", "initials", "places").mapInPandas(
        _lines, "key string, slice int, number long, place long, edit string, role string"
    )
    stay = edits.where("edit in ('K', 'R')").withColumnRenamed("role", "given").join(turns.select("place", "role", "text"), "place")
    stay = stay.select("key", "slice", "number", "edit", F.coalesce("given", "role").alias("role"), "text")
    added = edits.where("edit = 'I'").select("key", "slice", "number", "edit", "role", F.lit("").alias("text"))
    return stay.unionByName(added)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of every key's lines, which come in order; only the running state is held."""
    key, state = None, None
    for batch in batches:
        done = []
        for own, line in zip(batch["key"], batch["line"]):
            data = line.encode("utf-8", "surrogatepass")
            if own != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(data)
            else:
                state.update(b"\n" + data)
        yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "repaired_sha256"])


def digests(repaired: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of the lines ``role:text``, joined by line feeds, of every conversation left with a turn."""
    lines = repaired.select("key", "slice", "number", F.concat("role", F.lit(":"), "text").alias("line"))
    in_order = lines.repartition("key").sortWithinPartitions("key", "slice", "number").select("key", "line")
    return in_order.mapInPandas(_digests, "key string, repaired_sha256 string")


def report(spark: SparkSession, conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """The repair of ``damaged`` for every id of ``conversations``, those left without a row included."""
    found, repaired = repair(spark, damaged)
    ids = conversations.select(key_of(F.col("conv_id")).alias("key"), "conv_id").distinct()
    joined = ids.join(found.drop("conv_id"), "key", "left").join(digests(repaired), "key", "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
