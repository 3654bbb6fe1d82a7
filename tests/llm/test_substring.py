from hashlib import blake2b
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.conftest import prose
from wardflow.llm import substring


@given(st.text(alphabet="ab .!?\n\t é", max_size=60))
def test_units_cover_the_text(text):
    found = substring.units(text)
    assert "".join(text[b:e] for b, e, _ in found) == (text if text.split() else "") or text[: found[0][0]].split() == []
    assert [w for _, _, words in found for w in words] == text.lower().split()


def test_later_copies_go_and_offsets_fit(spark):
    shared = " ".join(prose(50 + i, 9) for i in range(6))
    rows = [
        (1, f"{prose(1, 12)} {shared} {prose(2, 12)}"),
        (2, f"{prose(3, 12)} {shared.upper()} {prose(4, 12)}"),
        (3, prose(5, 40)),
        (4, f"Short. Again. {prose(6, 30)}"),
        (5, f"Short. Again. {prose(7, 30)}"),
        (6, f"{prose(8, 21)}\n{prose(9, 12)}\n{prose(8, 21)}"),
    ]
    got = {r.doc_id: r for r in substring.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert all(got[d].text == texts[d] and got[d].spans == [] for d in (1, 3, 4, 5))
    assert got[2].text == f"{prose(3, 12)} {prose(4, 12)}" and len(got[2].spans) == 1
    begin, end = got[2].spans[0]
    assert texts[2][begin:end].strip() == shared.upper()
    assert got[6].text == f"{prose(8, 21)}\n{prose(9, 12)}\n"


def test_odd_rows(spark, clashing_docs, no_docs):
    got = substring.remove_repeats(spark, clashing_docs)
    assert got.columns == clashing_docs.columns
    rows = got.collect()
    assert len(rows) == clashing_docs.count()
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[1] == [None] and texts[2] == [""]
    assert texts[8] == ["", ""] and texts[7] == [prose(2, 40)]  # copies of a later document go with it
    assert texts[13] == [prose(8, 30) + "\n"]
    assert all(len(r.text) == r.n_chars for r in rows if r.doc_id in (8, 13))
    assert substring.remove_repeats(spark, no_docs).count() == 0
    plain = substring.remove_repeats(spark, clashing_docs, spans_as=None)
    assert plain.columns == clashing_docs.columns and {r.spans for r in plain.collect()} == {"own"}


def test_passages_that_begin_and_end_inside_sentences(spark):
    rows, passages = [], {}
    for i, n in enumerate((51, 60, 75, 90)):
        words = prose(100 + i, 200)[:-1].lower().split()
        # One long sentence, or sentences of 30 words, of which neither end is whole.
        text = words[40 : 40 + n]
        if i % 2:
            text[29] += "."
        passages[i + 10] = " ".join(text)
        rows.append((i, " ".join([*words[:40], *text, *words[40 + n :]])))
        rows.append((i + 10, f"{prose(200 + i, 45)[:-1]} {passages[i + 10]} {prose(300 + i, 45)}"))
    got = {r.doc_id: r for r in substring.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert all(got[d].text == texts[d] for d in range(4))
    assert {d: texts[d][got[d].spans[0].begin : got[d].spans[0].end].strip() for d in passages} == passages
    assert all(len(got[d].spans) == 1 for d in passages)


def test_any_repeat_of_fifty_words_shares_a_window():
    words = prose(1, 400).split()
    for begin in range(0, 340, 7):
        passage = words[begin : begin + 50]
        whole = {tuple(words[p : p + 20]) for p in substring.windows(words)}
        other = [*prose(2, 33).split(), *passage, *prose(3, 33).split()]
        assert whole & {tuple(other[p : p + 20]) for p in substring.windows(other)}


def test_a_loop_keeps_its_first_words(spark):
    rows = [(1, "la " * 300)]
    got = substring.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert 20 <= len(got.text.split()) <= 50


@given(st.lists(st.sampled_from(["a", "Bb", "ΣοΣ", "İx", "c.", "d?", "\n", "  ", " ", "e!\n"]), max_size=120))
def test_digests_are_those_of_units_and_windows(parts):
    text = " ".join(parts)
    batch = pd.DataFrame({"doc_id": [7], "version": [9], "text": [text]})
    got = pd.concat(list(substring._digested(20)(iter([batch]))))
    words = [w for _, _, of in substring.units(text) for w in of]
    ends = list(accumulate(len(of) for _, _, of in substring.units(text)))
    places = list(zip([0, *ends], ends)) + [(p, p + 20) for p in substring.windows(words)]
    digest = [blake2b(" ".join(words[a:b]).encode(), digest_size=12).digest() for a, b in places]
    assert list(zip(got["first"], got["last"])) == places and list(got["digest"]) == digest
    assert set(got["doc_id"]) <= {7} and set(got["version"]) <= {9}
    assert got["first"].dtype == got["last"].dtype == "int32"  # as Spark takes them, not one by one


def test_many_texts_are_digested_in_one_pass(monkeypatch):
    passes = []
    hashed = substring.hash_spans
    monkeypatch.setattr(substring, "hash_spans", lambda *of: passes.append(1) or hashed(*of))
    texts = [prose(i, 20 + i) for i in range(100)] + [" \n", "Ends. Mid\nline", prose(7, 60)]
    batch = pd.DataFrame({"doc_id": range(len(texts)), "version": range(len(texts)), "text": texts})
    together = pd.concat(substring._digested(20)(iter([batch])))
    assert len(passes) == 1
    alone = pd.concat([f for i in range(len(texts)) for f in substring._digested(20)(iter([batch[i : i + 1]]))])
    assert sorted(together.itertuples(index=False, name=None)) == sorted(alone.itertuples(index=False, name=None))


def test_runs_inside_longer_ones_are_not_compared(spark):
    # Three texts' passages behind each other: only the two outer ends can go on.
    parts = ["\n".join(prose(10 * i + j, 25) for j in range(4)) for i in range(1, 4)]
    rows = [(i, f"{prose(40 + i, 20)}\n{part}\n{prose(60 + i, 20)}") for i, part in enumerate(parts)] + [(9, "\n".join([prose(1, 30), *parts, prose(2, 30)]))]
    found = substring.repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    runs = [run for of in found for run in of.runs]
    assert {of.doc_id for of in found} == {9}
    assert (min(r["first"] for r in runs), max(r["last"] for r in runs)) == (30, 330)
    assert len(runs) <= 3 and sum(bool(r["before"]) + bool(r["behind"]) for r in runs) <= 2


def test_a_text_whose_rows_span_batches_is_joined_as_a_whole():
    def rows(at, n):
        return {
            "doc_id": [None] * at + [1] * n, "version": [5] * (at + n), "first": [*range(0, 10 * at, 10), *range(0, 10 * n, 10)],
            "last": [*range(10, 10 * at + 10, 10), *range(10, 10 * n + 10, 10)], "from_id": [0] * (at + n), "from_version": [3] * (at + n),
            "shift": [0] * (at + n), "itself": [False] * (at + n),
        }

    types = {"doc_id": pa.int64(), "version": pa.int64(), "first": pa.int32(), "last": pa.int32()}
    types |= {"from_id": pa.int64(), "from_version": pa.int64(), "shift": pa.int32(), "itself": pa.bool_()}
    whole = pa.RecordBatch.from_pydict(rows(7, 9), pa.schema(types))
    for size in (1, 3, 16):
        batches = iter([whole[at : at + size] for at in range(0, 16, size)])
        got = pa.Table.from_batches(list(substring._joined(20)(batches))).to_pylist()
        assert [(r["doc_id"], r["first"], r["last"]) for r in got if r["from_id"] is None] == [(None, 0, 70), (1, 0, 90)]
