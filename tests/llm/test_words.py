import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from adpulse.llm import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="ab \n\t\x0bÄ🙂 ", max_size=60)), max_size=8
)


def _split(texts, lower=False):
    """Words of all texts, as hashes per text."""
    found = []
    for block in words.blocks(pa.array(texts, pa.string()), lower):
        for low, high in zip(block.bounds, block.bounds[1:]):
            found.append(block.hashes[low:high].tolist())
    return found


@given(TEXTS)
@settings(max_examples=60, deadline=None)
def test_equal_words_have_equal_hashes_and_others_not(texts):
    found = _split(texts)
    expected = [WORD.findall(text or "") for text in texts]
    assert [len(f) for f in found] == [len(e) for e in expected]
    pairs = {(h, w) for f, e in zip(found, expected) for h, w in zip(f, e)}
    assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


@given(TEXTS)
@settings(max_examples=40, deadline=None)
def test_pieces_do_not_change_the_words(texts):
    whole = _split(texts)
    before, words.PIECE = words.PIECE, 5
    try:
        assert _split(texts) == whole
    finally:
        words.PIECE = before


def test_lower_case_is_ascii_only():
    upper, lower, other = _split(["ABZ", "abz", "Äbz"], lower=True)
    assert upper == lower != other
    assert _split(["Ä"], lower=True) != _split(["ä"], lower=True)


@given(TEXTS)
@settings(max_examples=40, deadline=None)
def test_lines_and_windows_match_python(texts):
    for block in words.blocks(pa.array(texts, pa.string())):
        hashed, owner = words.lines(block)
        _, later = words.repeated(hashed, owner)
        got = np.bincount(owner[later], minlength=len(block.counts)).tolist()
        expected = []
        for text in texts[block.first : block.first + len(block.counts)]:
            lines = [line for line in (text or "").split("\n") if WORD.search(line)]
            expected.append(len(lines) - len(set(lines)))
        assert got == expected
        window, at = words.windows(block, 2)
        for k, text in enumerate(texts[block.first : block.first + len(block.counts)]):
            found = WORD.findall(text or "")
            pairs = Counter(zip(found, found[1:]))
            own = Counter(window[block.owner[at] == k].tolist())
            assert sorted(own.values()) == sorted(pairs.values())


@given(TEXTS)
@settings(max_examples=40, deadline=None)
def test_word_counts(texts):
    got = words.word_counts(pa.array(texts, pa.string())).to_pylist()
    assert got == [len(WORD.findall(text or "")) for text in texts]


def test_a_slice_of_an_array_is_read_from_its_offset():
    texts = pa.array(["a b", "c", None, "d e f"], pa.string()).slice(1, 3)
    assert [len(found) for found in _split_array(texts)] == [1, 0, 3]


def _split_array(texts):
    return [
        block.hashes[low:high]
        for block in words.blocks(texts)
        for low, high in zip(block.bounds, block.bounds[1:])
    ]
