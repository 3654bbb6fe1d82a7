import random
import re
import string

from wardflow.llm import notices
from wardflow.llm.notices import NOTICES, Finder, Notice

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def fewest(text, notice):
    """Fewest edits of any run of whole words that holds the key, by trying them all."""
    w, key, most = words(text), notice.key.split(), notices.edits_allowed(notice.text)
    best = None
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            run = w[i:j]
            if len(" ".join(run)) > len(notice.text) + most:
                break
            before, _, after = notice.text.partition(notice.key)
            for p in range(len(run)):
                if run[p : p + len(key)] == key:
                    left, right = "".join(x + " " for x in run[:p]), "".join(" " + x for x in run[p + len(key) :])
                    if (before or not left) and (after or not right):
                        d = distance(left, before) + distance(right, after)
                        if d <= most and (best is None or d < best):
                            best = d
    return best


def damaged(text, edits, draw):
    for _ in range(edits):
        at = draw.randrange(len(text))
        text = draw.choice([text[:at] + text[at + 1 :], text[:at] + draw.choice("xqé ") + text[at:], text[:at] + draw.choice("xqñ") + text[at + 1 :]])
    return text


def base_places(text):
    w, out = words(text), []
    for notice in NOTICES:
        if notice.base:
            p = notice.text.split()
            out += [(i, notice.label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return sorted(out)


def test_finds_what_trying_every_run_finds():
    draw = random.Random(5)
    finder = Finder(NOTICES)
    for round_ in range(250):
        notice = draw.choice(NOTICES)
        parts = [draw.choice(["under the", "mit", "license", "de la", "2", "gnu general", "cc by", "漢字 ñ"]) for _ in range(8)]
        parts.insert(draw.randrange(9), damaged(notice.text, draw.randint(0, 4), draw))
        text = " ".join(parts)
        best = {}
        for hit in finder.hits(text)[1]:
            best[hit["notice"]] = min(hit["edits"], best.get(hit["notice"], 99))
        for other in NOTICES:
            assert best.get(other.text) == fewest(text, other), (text, other)


def test_base_places_and_spans(spark, clashing_docs):
    extra = [
        (20, "Released under the MIT License. Again: under\nthe--mit LICENSE, and CC BY-NC 4.0"),
        (21, "Licensed under the Apache License, Version 2.0." * 3),
        (22, "é " * 50 + "Relaesed undr the MIT Licence!"),
        (23, "cc by nc " * 5_000),
        (24, "under the mpl license; gnu general public license version 9"),
        (25, "under the mit licenses"),
        (26, None),
    ]
    docs = clashing_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = notices.find_notices(docs).collect()
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    got = sorted(((r.doc_id, r.n_words, sorted((h.first_word, h.label) for h in r.hits if h.base and h.edits == 0)) for r in found), key=repr)
    assert got == sorted(((i, len(words(t)), base_places(t)) for i, t in texts), key=repr)
    by_id = dict(texts)
    for row in found:
        for h in row.hits:
            assert by_id[row.doc_id][h.begin : h.end] == h.found
            assert distance(" ".join(words(h.found)), h.notice) == h.edits
    labels = {r.doc_id: r for r in notices.summary(notices.find_notices(docs)).where("doc_id >= 20").collect()}
    assert labels[20].labels == "cc-by-nc,mit" and labels[20].n_base == 3 and (labels[20].first_word, labels[20].last_word) == (1, 11)
    assert labels[21].labels == "apache-2" and labels[21].n_base == 3 and labels[21].score == 1
    assert labels[22].labels == "mit" and labels[22].base_labels == "" and 0.9 <= labels[22].score < 1 and labels[22].first_word is None
    assert labels[23].n_base == 5_000
    assert labels[24].labels == "" and labels[24].score == 0
    assert labels[25].base_labels == "" and labels[25].labels == "mit"
    assert (labels[26].n_words, labels[26].labels) == (0, "")


def test_empty_table_and_no_notices(spark, no_docs, odd_docs):
    assert notices.summary(notices.find_notices(no_docs)).count() == 0
    assert all(not r.hits for r in notices.find_notices(odd_docs, []).collect())


def test_own_notices_and_rate():
    finder = Finder([Notice("own", "all of this is ours alone", "ours")], rate=0.2)
    assert [h["edits"] for h in finder.hits("All of that is ours, alone")[1]] == [2]
    assert not finder.hits("All of that is yours, alone")[1]
