import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import bytewords as bw

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 \n\t\x0b-é日", max_size=40)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_equal_the_patterns(texts):
    for table, pattern, lower in (
        (bw.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
        (bw.SOLID, r"[^\x20\x09-\x0D]+", False),
    ):
        words = bw.split_words(pa.array(texts, pa.string()), table, lower)
        found = [
            [words.slice(i, i + 1).decode() for i in range(a, b)]
            for a, b in zip(words.first[:-1], words.first[1:])
        ]
        low = str.maketrans("AZ", "az") if lower else {}
        assert found == [re.findall(pattern, (t or "").translate(low)) for t in texts]


def test_hashes_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr(bw, "PIECE", 16)
    words = bw.split_words(pa.array(["one two three", "two", "three " * 50 + "one"]), bw.SOLID)
    hashes = bw.hash_words(words)
    by_word = {}
    for i in range(len(hashes)):
        by_word.setdefault(words.slice(i, i + 1), set()).add(int(hashes[i]))
    assert all(len(h) == 1 for h in by_word.values())
    assert len({next(iter(h)) for h in by_word.values()}) == 3


@pytest.mark.parametrize("size", [1, 2, 3, 5, 6, 8, 13, 35])
def test_roll_and_minimum(size):
    rng = np.random.default_rng(size)
    values = rng.integers(0, 4, 200).astype(np.uint64)
    rolled = bw.roll(values, size)
    seen = {}
    for i, h in enumerate(rolled.tolist()):
        key = tuple(values[i : i + size].tolist())
        assert seen.setdefault(key, h) == h
    assert len(set(seen.values())) == len(seen)
    least = bw.rightmost_minimum(values, size)
    for i, at in enumerate(least.tolist()):
        window = values[i : i + size]
        assert at == i + max(j for j, v in enumerate(window) if v == window.min())
    assert len(bw.roll(values[:3], 4)) == len(bw.rightmost_minimum(values[:3], 4)) == 0
