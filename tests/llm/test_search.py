import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from wardflow.llm import search
from wardflow.llm.common import words_of


def brute(docs, queries, k):
    bags = [(d, Counter(words_of(t))) for d, t in docs]
    n, df = len(bags), Counter(w for _, c in bags for w in c)
    mean = sum(sum(c.values()) for _, c in bags) / n
    out = {}
    for query, text in queries:
        scores = []
        for d, c in bags:
            length = sum(c.values())
            s = sum(
                math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length / mean))
                for w in set(words_of(text))
                if w in c
            )
            if s > 0:
                scores.append((s, d))
        if scores:
            out[query] = dict((d, s) for s, d in scores), sorted((s for s, _ in scores), reverse=True)[:k]
    return out


@pytest.mark.parametrize("terms", [2_000_000, 1500])
def test_equals_brute_force(spark, monkeypatch, terms):
    monkeypatch.setattr(search, "GROUP_TERMS", terms)
    docs = [(i, prose(i, 5 + i % 60, "a b c d e f" if i % 3 else "x y z b")) for i in range(900)] + [(1000 + i, prose(7, 12, "a b c d e f")) for i in range(15)]
    queries = [(d, t) for d, t in docs if d % 20 == 0]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    asked = spark.createDataFrame(queries, "query_id long, text string")
    got = defaultdict(list)
    for r in search.top_k(spark, frame, asked, k=7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.doc_id))
    want = brute(docs, queries, 7)
    assert got.keys() == want.keys()
    for query, rows in got.items():
        scores, best = want[query]
        assert [s for s, _ in rows] == pytest.approx(best, abs=1e-6)
        assert all(scores[d] == pytest.approx(s, abs=1e-6) for s, d in rows)
        assert rows == sorted(rows, key=lambda x: (-x[0], x[1])) and len({d for _, d in rows}) == len(rows)


def test_odd_rows(spark, clashing_docs, no_docs):
    queries = clashing_docs.select(F.col("doc_id").alias("query_id"), "text")
    got = search.top_k(spark, clashing_docs, queries, k=3).collect()
    found = {r.query_id for r in got}
    assert None not in found and 1 not in found and 2 not in found and {4, 5, 8, 9, 11} <= found
    assert [r.doc_id for r in sorted((r for r in got if r.query_id == 7), key=lambda r: r.rank)] == [7, 8, 8]
    assert search.top_k(spark, no_docs, queries).count() == 0
    assert search.top_k(spark, clashing_docs, queries.where("false")).count() == 0


def test_empty_texts_do_not_fill_a_shard(spark, monkeypatch):
    """A shard is closed by its documents too, in whatever order they come."""
    import pandas as pd

    class At:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(search, "TaskContext", type("T", (), {"get": staticmethod(lambda: At)}))
    batch = pd.DataFrame({"doc_id": range(45_000), "text": ["", "a b"] * 22_500})
    shards = [row for frame in search._shards(iter([batch])) for row in frame.itertuples()]
    assert [len(s.ids) for s in shards] == [20_000, 20_000, 5_000]
    assert [s.shard for s in shards] == [3 << 32, (3 << 32) + 1, (3 << 32) + 2]


def test_a_block_keeps_the_columns_of_its_words(monkeypatch):
    """Texts of two languages share no words, so no block is multiplied with words of both."""
    import numpy as np
    import pandas as pd

    class At:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(search, "TaskContext", type("T", (), {"get": staticmethod(lambda: At)}))
    texts = ["a b c", "x y z"] * search.BLOCK
    shard = next(search._shards(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": texts})]))).iloc[0]
    terms = np.concatenate([np.unique(search.hash_words(t)) for t in texts[:2]])
    index = search.Index(shard, search.Group([0, 1], np.array([3, 3]), terms, np.ones(6)), 3.0)
    assert [m.shape for m in index.matrices] == [(search.BLOCK, 3)] * 2
    assert sorted(np.concatenate(index.held)) == list(range(6))


def shards_of(monkeypatch, docs):
    import pandas as pd

    class At:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(search, "TaskContext", type("T", (), {"get": staticmethod(lambda: At)}))
    frame = pd.DataFrame(docs, columns=["doc_id", "text"])
    return [row for made in search._shards(iter([frame])) for _, row in made.iterrows()]


def group_of(docs, queries):
    import numpy as np

    df = Counter(w for _, t in docs for w in np.unique(search.hash_words(t)).tolist())
    sets = [np.unique(search.hash_words(t)) for _, t in queries]
    terms = np.concatenate(sets)
    idf = np.array([math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) for w in terms.tolist()])
    return search.Group([q for q, _ in queries], np.array([len(s) for s in sets]), terms, idf)


@pytest.mark.parametrize("block, dense, chunk", [(16, 3, 8), (32, 1, 50), (8, 9, 7)])
def test_lists_and_matrices_give_the_same(monkeypatch, block, dense, chunk):
    """Whatever is a column and whatever a list, over several shards."""
    for name, value in (("BLOCK", block), ("DENSE", dense), ("CHUNK", chunk), ("SHARD_DOCS", 130)):
        monkeypatch.setattr(search, name, value)
    docs = [(i, prose(i, 4 + i % 70, "a b c d e f" if i % 3 else "x y z b")) for i in range(600)]
    docs += [(600 + i, prose(i, 30, "a b c d e f")) for i in range(12)] + [(700, ""), (701, "only once")]
    queries = [(d, t) for d, t in docs if d % 13 == 0]
    group = group_of(docs, queries)
    best = search.Best(len(group.ids), 5)
    mean = sum(len(words_of(t)) for _, t in docs) / len(docs)
    shards = shards_of(monkeypatch, docs)
    assert len(shards) == 5
    for shard in shards:
        index = search.Index(shard, group, mean)
        for first in range(0, len(group.ids), chunk):
            index.score(group, first, min(first + chunk, len(group.ids)), best)
    want = brute(docs, queries, 5)
    for query, found in zip(group.ids, best.found):
        scores, top = want[query]
        assert [-s / search.UNIT for s, _, _ in found] == pytest.approx(top, abs=1e-6)
        assert all(scores[d] == pytest.approx(-s / search.UNIT, abs=1e-6) for s, _, d in found)
        assert found == sorted(found)


def test_words_of_few_documents_are_not_multiplied(monkeypatch):
    """A column of a block's matrix holds DENSE postings, so cells are bounded by postings."""
    import random

    draw = random.Random(1)
    words = [f"w{i}" for i in range(1500)]
    docs = [(i, " ".join(draw.sample(words, 30))) for i in range(2048)]
    (shard,) = shards_of(monkeypatch, docs)
    index = search.Index(shard, group_of(docs, docs[:200]), 30.0)
    postings = sum(len(set(t.split())) for _, t in docs)
    assert sum(m.size for m in index.matrices) <= 8 * postings
