import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from holdfast.llm.packing import merger as merged
from holdfast.llm.token_counts import TOKENIZER, counter
from holdfast.llm.word_merge import LONGEST, WordMerger

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def merger():
    return WordMerger(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abehinorst'.,0\u00e9\u4f60", min_size=1, max_size=24), max_size=40))
def test_words_against_the_prefix_tables(words):
    tokens = counter(PATH)
    assert merged(PATH)[0].counts(words).tolist() == [tokens.word_count(w) for w in words]


def test_words_of_all_lengths(merger):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("etaoinshrdlu"), n)) for n in range(1, LONGEST + 3) for _ in range(3)]
    found, tokens = merger.counts(words), counter(PATH)
    assert [c for w, c in zip(words, found, strict=True) if len(w) <= LONGEST] == [
        tokens.word_count(w) for w in words if len(w) <= LONGEST
    ]
    assert all(c == -1 for w, c in zip(words, found, strict=True) if len(w) > LONGEST)


def test_ties_merge_from_the_left(merger):
    tokens = counter(PATH)
    words = [c * n for c in ("a", "ha", "lol", "0", "\u00e9") for n in range(1, 20)]
    assert merger.counts(words).tolist() == [tokens.word_count(w) for w in words]


def test_nothing(merger):
    assert merger.counts([]).tolist() == []
