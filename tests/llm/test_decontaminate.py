import random
import re
import string
import zlib

import pytest

from wardflow.llm import decontaminate

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, bench):
    out = []
    grams = {}
    for item, text in bench:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    for doc, text in docs:
        w = words(text)
        hit, items = set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    items |= grams[tuple(w[i : i + size])]
        out.append((doc, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


BENCH = [
    (1, "One two"),
    (2, None),
    (3, "..."),
    (4, " ".join(f"w{i}" for i in range(20))),
    (4, " ".join(f"w{i}" for i in range(20))),
    (5, " ".join(f"w{i}" for i in range(5, 18))),
    (10, "one, TWO!"),
]


@pytest.mark.parametrize("limit", [0, 1000])
def test_equals_brute_force(spark, clashing_docs, limit):
    extra = [(20, "x " * 30 + " ".join(f"W{i}" for i in range(3, 19)) + " y" * 400), (21, " ".join(f"w{i}" for i in range(20)) * 1), (22, "one two one two")]
    docs = clashing_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.scan(docs, bench, set_limit=limit).collect()
    mine = [(r.doc_id, r.n_words, sum(s.end - s.begin for s in r.spans), list(r["items"])) for r in got]
    want = brute([tuple(r) for r in docs.collect()], BENCH)
    assert sorted(mine, key=repr) == sorted((w[:4] for w in want), key=repr)


def test_no_benchmark_is_clean(spark, odd_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.judge(odd_docs, bench).collect()
    assert len(got) == odd_docs.count() and not any(r.contaminated for r in got)


def test_removal_keeps_columns_and_clean_rows(spark, clashing_docs, no_docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = decontaminate.remove_contaminated(clashing_docs, bench)
    assert kept.columns == clashing_docs.columns
    assert kept.count() == clashing_docs.count() - 2  # "one two" and "ONE  two"
    assert decontaminate.remove_contaminated(no_docs, bench).count() == 0


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "a one two b"), (2, "Clean, text")], "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()} == {1: "a b", 2: "Clean, text"}


def test_no_python_in_the_plan(spark, odd_docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    plan = decontaminate.judge(odd_docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_equal_checksum_are_told_apart(spark):
    """Texts without an id whose crc32 is the same: each is cut by its own hits."""
    draw, seen, pair = random.Random(7), {}, None
    for i in range(400_000):
        text = f"{'one two' if i % 2 else 'x'} {draw.getrandbits(64):x}"
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other[0] != text[0]:
            pair = [other, text]
            break
    assert pair
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = spark.createDataFrame([(None, t) for t in pair], "doc_id long, text string")
    kept = [r.text for r in decontaminate.remove_contaminated(docs, bench).collect()]
    assert kept == [t for t in pair if t[0] == "x"]
    cut = sorted(r.text for r in decontaminate.remove_spans(docs, bench).collect())
    assert cut == sorted(t.replace("one two ", "") for t in pair)
