"""Words of byte buffers against regular expressions."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tapeline.llm.texts import Texts, slabs

LETTERS = st.text(alphabet="ab \n\t\x0b é🙂", max_size=40)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS), max_size=6))
def test_words_and_windows(texts):
    read = Texts.of(pa.array(texts, pa.string()))
    words = read.words
    found = [[read.data[s:e].tobytes().decode() for s, e in zip(words.starts[a:b], words.ends[a:b])] for a, b in zip(words.bounds, words.bounds[1:])]
    assert found == [split(t) for t in texts]
    values, at = words.windows(3)
    expected = [tuple(w[i : i + 3]) for w in found for i in range(len(w) - 2)]
    assert len(values) == len(expected) == len(at)
    same = {}
    for value, window in zip(values.tolist(), expected):
        assert same.setdefault(value, window) == window
    assert len(same) == len(set(expected))


def test_long_words_and_lower_case():
    read = Texts.of(pa.array(["A" * 1000 + " B É", "a" * 1000 + " b É"]), lower=True)
    hashes = read.words.hashes
    assert hashes[:3].tolist() == hashes[3:].tolist()
    assert len(set(Texts.of(pa.array(["a" * n for n in range(1, 600)])).words.hashes.tolist())) == 599


def test_slabs_keep_all_rows_and_long_texts_whole():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 10, None, "y" * 1000, "", "z" * 10]})
    parts = list(slabs(iter([batch]), limit=100))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    assert len(parts) > 1 and Texts.of(pa.array([], pa.string())).offsets.tolist() == [0]
    assert np.array_equal(Texts.of(batch.column(0).slice(2, 2)).sizes, [1000, 0])
