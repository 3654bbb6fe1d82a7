from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2])), max_size=40))
def test_every_item_has_the_tightest_compatible_sequence(items):
    items.sort(key=lambda x: -x[0])
    placed = packing.place([x[0] for x in items], [x[1] for x in items], [x[2] for x in items], 20)
    rooms, held = {}, defaultdict(list)
    for (length, source, cluster), number in zip(items, placed):
        fit = {
            n: room
            for n, room in rooms.items()
            if room >= length and not any((source is not None and s == source) or (cluster is not None and c == cluster) for s, c in held[n])
        }
        if fit:
            assert rooms[number] == min(fit.values()) and number in fit
        else:
            assert number not in rooms
            rooms[number] = 20
        rooms[number] -= length
        held[number].append((source, cluster))


def test_all_words_are_placed_once(spark, clashing_docs, no_docs):
    packed = packing.pack(spark, clashing_docs, capacity=64, shard_docs=4).collect()
    need = sorted(
        (r.doc_id or 0, r.n) for r in clashing_docs.selectExpr("doc_id", "coalesce(regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0) n").collect()
    )
    got = defaultdict(int)
    for r in packed:
        got[r.doc_id or 0] += r.length
    want = defaultdict(int)
    for d, n in need:
        want[d] += n
    assert got == want
    used = defaultdict(list)
    for r in packed:
        if r.sequence_id is None:
            assert r.length == 0
        else:
            used[r.sequence_id].append((r.position, r.length))
    for parts in used.values():
        at = 0
        for position, length in sorted(parts):
            assert position == at
            at += length
        assert at <= 64
    assert packing.pack(spark, no_docs).count() == 0


def test_sequences_hold_the_words(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "s"), (2, "f g", "t"), (3, "h", "t")], "doc_id long, text string, source string")
    packed = packing.pack(spark, docs, capacity=4)
    texts = sorted(r.text for r in packing.sequences(packed, docs).collect())
    assert sorted(" ".join(texts).split()) == list("abcdefgh") and texts[0] == "a b c d"


def test_equal_rows_without_an_id_are_dealt_out(spark):
    """No shard holds more than its share, and rows without words go past them."""
    from pyspark.sql import functions as F

    docs = spark.range(6_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same words here").alias("text"), F.lit("s").alias("source"))
    empty = spark.range(50_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("s").alias("source"))
    packed = packing.pack(spark, docs.unionByName(empty), capacity=64, shard_docs=500)
    rows = packed.collect()
    assert len(rows) == 56_000 and sum(r.sequence_id is None for r in rows) == 50_000
    shards = Counter(r.sequence_id >> 32 for r in rows if r.sequence_id is not None)
    assert len(shards) == 12 and max(shards.values()) < 700
    assert len({r.sequence_id for r in rows if r.sequence_id is not None}) == 6_000  # copies never share one
