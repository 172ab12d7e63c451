import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewise.llm import common


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\tXé漢\x0b\x1c", max_size=60))
def test_words_are_those_of_the_pattern(text):
    raw = text.encode()
    h, a, b = common.words_at(np.frombuffer(raw, np.uint8))
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    assert [raw[x:y] for x, y in zip(a, b)] == words
    lower = [w.lower() for w in words]  # ASCII letters only
    assert len(set(h.tolist())) == len(set(lower))
    assert all((h[i] == h[j]) == (lower[i] == lower[j]) for i in range(len(h)) for j in range(len(h)))


def test_words_across_slices_and_beyond_one(monkeypatch):
    text = ("word %d " * 4 % (1, 2, 3, 4) + "y" * 90 + " tail ").encode() * 40
    want = common.words_at(np.frombuffer(text, np.uint8))
    monkeypatch.setattr(common, "_SLICE", 64)
    common._tables.cache_clear()
    got = common.words_at(np.frombuffer(text, np.uint8))
    monkeypatch.undo()
    common._tables.cache_clear()
    assert all((x == y).all() for x, y in zip(want, got))


def test_byte_views_of_sliced_and_null_columns():
    column = pa.array(["ab", None, "", "é"]).slice(1)
    assert [bytes(v) for v in common.byte_views(column)] == [b"", b"", "é".encode()]
