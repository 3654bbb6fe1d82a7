import random

import pytest

from tests.llm.conftest import prose
from wardflow.llm import neardup
from wardflow.llm.common import words_of


def brute(docs):
    sets = {}
    for doc, text in docs:
        w = words_of(text)
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[doc] = grams
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def edited(words, draw, share):
    return [("new" + str(draw.random())[2:6] if draw.random() < share else w) for w in words]


def test_equals_brute_force_on_chains_and_copies(spark):
    draw = random.Random(5)
    docs, doc = [], 100
    for group in range(6):
        words = prose(group, 120).split()
        for _ in range(15):
            docs.append((doc, " ".join(words)))
            doc -= 1 if group % 2 else -7
            words = edited(words, draw, 0.03) if draw.random() < 0.8 else words
    docs = list({d: (d, t) for d, t in docs}.values())
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.link(spark, frame).collect()}
    assert got == brute(docs)


@pytest.mark.parametrize("tile", [neardup.TILE, 16])
def test_hot_bucket_members_are_all_compared(spark, monkeypatch, tile):
    """A base text with many edits of it, which are unlike each other."""
    monkeypatch.setattr(neardup, "TILE", tile)
    draw = random.Random(9)
    base = prose(77, 100).split()
    docs = [(500, " ".join(base))]
    for i in range(120):
        at = draw.randrange(0, 90)
        edit = base[:at] + [f"x{i}", f"y{i}"] + base[at + 2 :]
        if i % 3 == 0:  # too far from the base, but near to their own copy
            edit[at // 2] = f"z{i}"
            edit[at // 3] = f"v{i}"
            docs.append((2000 + i, " ".join(edit[:-1] + [f"w{i}"])))
        docs.append((i + 1 if i % 2 else 1000 + i, " ".join(edit)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.link(spark, frame).collect()}
    assert got == brute(docs)


def test_odd_rows(spark, clashing_docs, no_docs):
    got = {r.doc_id: r for r in neardup.link(spark, clashing_docs).collect()}
    assert sorted(got) == list(range(1, 14))
    assert [got[d].n_shingles for d in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert got[5].component_id == 4 and got[8].component_id == 7 and got[1].kept and got[2].kept
    assert neardup.link(spark, no_docs).count() == 0
    kept = neardup.keep_representatives(spark, clashing_docs)
    assert kept.columns == clashing_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 6, 7, 9, 9, 10, 11, 12, 13] and None in ids


def test_components_are_the_smallest_reachable(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (150, 200), (100, 150)] + [(300, k) for k in range(301, 340)]
    links = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in chain], "a long, b long")
    got = {r.node: r.component for r in neardup.components(spark, links).collect()}
    want = {i: 1 for i in range(2, 61)} | {150: 100, 200: 100} | {k: 300 for k in range(301, 340)}
    assert got == want


def test_every_row_is_judged_by_its_own_text(spark):
    """Rows of one id with other texts, and rows without an id, are documents of their own."""
    t, u, v = (prose(400 + i, 60) for i in range(3))
    rows = [(5, t), (5, u), (9, v), (None, t), (None, prose(410, 60)), (None, v), (7, u + " one"), (5, t), (3, ""), (3, ""), (4, None)]
    kept = neardup.keep_representatives(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=repr)
    assert got == sorted([(5, t), (5, u), (9, v), (None, rows[4][1]), (3, ""), (3, ""), (4, None)], key=repr)
