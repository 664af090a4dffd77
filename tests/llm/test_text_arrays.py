import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cellspark.llm.common import Words, flat, slices, windows

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_windows_equal_plain_python(texts):
    data, offsets = flat(pa.array(texts, pa.string()))
    w = Words(data, offsets)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert w.counts().tolist() == [len(x) for x in plain]
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(w.starts, w.ends, strict=True)] == [x for p in plain for x in p]
    by_hash = {}
    for h, x in zip(w.hashes().tolist(), [x for p in plain for x in p], strict=True):
        assert by_hash.setdefault(h, x) == x
    assert len(set(by_hash.values())) == len(by_hash)
    h, first, rows = windows(w.hashes(), w.bounds, 3)
    want = [(r, tuple(p[k : k + 3])) for r, p in enumerate(plain) for k in range(len(p) - 2)]
    assert rows.tolist() == [r for r, _ in want]
    seen = {}
    for x, (_, win) in zip(h.tolist(), want, strict=True):
        assert seen.setdefault(win, x) == x
    assert len(set(seen.values())) == len(seen)
    del first


def test_slices_are_bounded_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 90, 3, 3, 3, 200)])], ["text"])
    parts = list(slices(iter([batch]), "text", 10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 10 for p in parts)


def test_sliced_arrays_keep_their_offsets():
    col = pa.array(["skip", "ab cd", None, "e"]).slice(1)
    data, offsets = flat(col)
    assert data.tobytes() == b"ab cde" and offsets.tolist() == [0, 5, 5, 6]
    assert np.array_equal(Words(data, offsets).counts(), [2, 0, 1])
