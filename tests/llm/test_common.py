import re

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from wardflow.llm import common

TEXT = st.text(alphabet="aAbB éÉñ\n\t\x0b\x0c\r\x1c\x85\xa0漢😀", max_size=80)
LOW = {i: i + 32 for i in range(65, 91)}


@given(TEXT)
def test_words_are_those_of_the_pattern(text):
    assert common.words_of(text) == re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOW))


@given(TEXT, TEXT)
def test_a_word_has_one_hash_wherever_it_stands(left, right):
    seen = {}
    for text in (left, right, f"{left} {right}"):
        words, hashes = common.words_of(text), common.hash_words(text).tolist()
        assert len(words) == len(hashes)
        for word, value in zip(words, hashes):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_pieces():
    text = "word " * 120_000 + "y" * 700_000 + " z"
    got = common.hash_words(text)
    assert len(got) == 120_002 and len(set(got[:-2].tolist())) == 1
    assert got[-1] == common.hash_words("Z")[0] and got[-2] == common.hash_words("y" * 700_000)[0]
    assert len(common.hash_words(None)) == len(common.hash_words(" \n")) == 0


def test_spans_follow_one_another():
    assert common.spans(np.array([5, 1, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]


def test_words_are_hashed_alike_by_their_places():
    for text in ("", "ein wort", "éa bß c " * 40_000, "x" * 300_000 + " y z"):
        words = text.split()
        data = " ".join(words).encode()
        edge = np.concatenate([[-1], np.flatnonzero(np.frombuffer(data, np.uint8) == 32), [len(data)]]) if words else np.zeros(1, int)
        assert (common.hash_spans(data, edge[:-1] + 1, edge[1:]) == common.hash_words(text)).all()
