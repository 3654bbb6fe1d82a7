import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from wardflow.llm import phrases

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, least, longest, first):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in often.items():
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        inside = any(
            g[0] == lang and len(g[1]) > len(p) and b >= a and any(g[1][i : i + len(p)] == p for i in range(len(g[1]))) for g, b in often.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, left, right, total[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1)
    )


def made_up(seed, docs):
    draw = random.Random(seed)
    words = "the of and To in ér ñandú 漢字 a b x-y st on".split(" ")
    line = "Of the old house, and of the new one in town"
    out = []
    for i in range(docs):
        text = "".join(draw.choice(words) + draw.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!"]) for _ in range(draw.randint(0, 60)))
        out.append((draw.choice(["en", "en", "en", "de", None]), draw.choice([text, text + line, line, line + " " + text, None, ""])))
    return out + [("en", "the " * 700), ("fr", " ".join(words) * 20)]


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("trigger", [1, 2, 32, 10_000])
def test_equals_brute_force(spark, trigger):
    rows = made_up(4, 300)
    docs = spark.createDataFrame([(i, t, lang, "own", "own") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, freq string, own string")
    assert got(phrases.collocations(spark, docs, least=12, first=30, trigger=trigger)) == brute(rows, 12, 5, 30)


def test_lengths_and_no_limit(spark):
    rows = made_up(9, 150)
    docs = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string")
    assert got(phrases.collocations(spark, docs, least=5, longest=3, first=None)) == brute(rows, 5, 3, None)


def test_each_phrase_begins_in_one_chunk():
    draw = random.Random(1)
    words = [draw.choice("abcdefgh") + draw.choice("xyz") for _ in range(2_000)]
    triggers = phrases._Triggers()
    own = []
    for chunk in phrases.chunks_of(" ".join(words).encode(), 5, triggers):
        mine, _, over = chunk.decode().partition("\t")
        assert 1 <= len(mine.split()) <= phrases.LONGEST_RUN
        own.append((mine.split(), over.split()))
    assert [w for mine, _ in own for w in mine] == words
    rest = words
    for mine, over in own:
        rest = rest[len(mine) :]
        assert over == rest[:4]


def test_packed_chunks_are_read_back():
    chunks = [b"a b", b"c\ta b", b"b b b\tc", b"a"]
    block = phrases.Block(*phrases.packed(chunks, ["en", "de", "en", "en"], [3, 1, 2, 5]))
    words = [block.known[i] for i in block.word]
    assert words == b" ".join(chunks).replace(b"\t", b" ").split(b" ")
    assert block.mine.tolist() == [True, True, True, False, False, True, True, True, False, True]
    assert block.left.tolist() == [2, 1, 3, 2, 1, 4, 3, 2, 1, 1] and block.freq.tolist() == [3, 3, 1, 1, 1, 2, 2, 2, 2, 5]
    pairs = {(r.lang, r.phrase): r.n for r in block.counts(2, None, 0).itertuples()}
    assert pairs == {("en", b"a b"): 3, ("de", b"c a"): 1, ("en", b"b b"): 4, ("en", b"b c"): 2}


def test_filter_holds_every_frequent_phrase(spark):
    some = [("en", f"w{i} v{i % 7}".encode()) for i in range(3_000)]
    whole = phrases.bit_filter(spark.createDataFrame(some, "lang string, phrase binary"), 2)
    first = phrases.hashes([p.split()[0] for _, p in some])
    second = phrases.hashes([p.split()[1] for _, p in some])
    lang = np.repeat(phrases.hashes([b"en"]), 2)
    hits = [phrases.passes(whole, phrases.keys(lang, np.array([a, b]), 2))[0] for a, b in zip(first, second)]
    assert all(hits)
    assert not phrases.passes(whole, phrases.keys(lang, np.array([second[0], first[0]]), 2))[0]


def test_products_beyond_64_bits(spark):
    big = 4 * 10**12
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", big), ("en", "a b", big - 1)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10**12)], "lang string, n long")
    row = phrases.scored(counts, totals).first()
    assert row.score == 1000 * (big - 1) * 9 * 10**12 // big**2


def test_odd_tables(spark, odd_docs, clashing_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    for docs in (odd_docs, clashing_docs):
        assert got(phrases.collocations(spark, docs, least=40, first=200)) == brute(rows, 40, 5, 200)
    assert phrases.collocations(spark, no_docs).count() == 0
