import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wardflow.llm import lm
from wardflow.llm.common import words_of


def test_counts_and_base_scores(spark, clashing_docs):
    training = F.coalesce(F.col("doc_id") % 5 != 3, F.lit(True))
    got = lm.score(spark, clashing_docs, training).collect()
    docs = [(r.doc_id, words_of(r.text) + ["\n"]) for r in clashing_docs.select("doc_id", "text").collect()]
    counts = Counter(w for d, x in docs if d is None or d % 5 != 3 for w in x)
    total, types = sum(counts.values()), len(counts)
    want = sorted((d or -1, len(x), sum(counts[w] > 0 for w in x), round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in x), 6)) for d, x in docs)
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    assert all(r.held_out == (r.doc_id is not None and r.doc_id % 5 == 3) for r in got)


def test_short_texts_share_one_unit_of_probability(spark):
    """All texts of up to two known words together: below one, and most of what ends so soon."""
    words = [f"w{i}" for i in range(12)]
    draw = np.random.Generator(np.random.PCG64(8))
    docs = [(i, " ".join(words[j] for j in draw.integers(0, 12, draw.integers(0, 4)))) for i in range(200)]
    texts = ["", *words, *(f"{a} {b}" for a in words for b in words)]
    probes = [(1000 + i, text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(docs + probes, "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(spark, frame, F.col("doc_id") < 1000).collect()}
    total = sum(10 ** got[i] for i, _ in probes)
    assert 0.4 < total < 1.0


def test_weights_follow_the_held_out_counts():
    cells = pd.DataFrame({"bucket": [1, 1], "b": [0, -1], "u": [20, 20], "n": [90, 10], "bigram": [1.0, 0.0], "unigram": [0.01, 0.01]})
    weights = lm.learn(cells, 1e-6)
    assert abs(weights[1].sum() - 1) < 1e-12 and weights[1][0] > 0.85 and weights[0][0] == 0.0
    assert np.allclose(weights[2], weights[1])


def test_bigrams_beat_the_base_on_held_out_text(spark):
    draw = np.random.Generator(np.random.PCG64(3))
    follow = {w: [f"w{(7 * w + k) % 50}" for k in range(3)] for w in range(50)}
    rows = []
    for i in range(300):
        w, out = int(draw.integers(50)), []
        for _ in range(40):
            out.append(f"w{w}")
            w = int(follow[w][int(draw.integers(3))][1:])
        rows.append((i, " ".join(out)))
    got = lm.score(spark, spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 250).where("held_out").collect()
    assert len(got) == 50 and all(r.score > 0.6 * r.base_score for r in got)


def test_nothing_to_learn_from(spark, odd_docs, no_docs):
    got = lm.score(spark, odd_docs, F.lit(False)).collect()
    assert len(got) == odd_docs.count() and all(r.n_known == 0 and math.isfinite(r.score) for r in got)
    assert lm.score(spark, no_docs, F.lit(True)).count() == 0


def test_counts_beyond_32_bits():
    for values in ([], [0, 5], [3_000_000_000, 1, 2**53], [-(2**40), 7]):
        assert lm.unsqueeze(lm.squeeze(np.array(values, np.int64))).tolist() == values
    small, wide = (len(lm.squeeze(np.full(1000, n))) for n in (5, 2**40))
    assert small < wide


def test_part_sums_beyond_32_bits():
    many = np.array([3_000_000_000, 1])
    group = pd.DataFrame([(0, 0, b, np.array([11, 12]), lm.squeeze(many), lm.squeeze(np.array([1, 0]))) for b in (0, 1)], columns=["order", "part", "block", "keys", "main", "held"])
    got = lm._answer(group)
    assert [lm.unsqueeze(x).tolist() for x in got["all"][:2]] == [[6_000_000_002, 2]] * 2
    assert got["total"].iloc[2] == 6_000_000_004
