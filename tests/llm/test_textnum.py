import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultshift.llm.textnum import Text, chunks, shingles

TEXTS = st.lists(st.text(alphabet="ab \n\té\x0b 漢", max_size=40), max_size=6)


@given(TEXTS)
@settings(max_examples=80, deadline=None)
def test_words_and_hashes(texts):
    t = Text(pa.array(texts, pa.string()))
    s, e, row = t.words()
    got = [(int(r), bytes(t.data[a:b]).decode()) for a, b, r in zip(s, e, row, strict=True)]
    assert got == [(i, w) for i, x in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", x)]
    h = t.hash(s, e)
    for i, (_, w) in enumerate(got):
        alone = Text(pa.array([" " + w], pa.string()))
        assert alone.hash(np.array([1]), np.array([1 + len(w.encode())]))[0] == h[i]


@given(st.lists(st.lists(st.integers(0, 3), max_size=9), max_size=4))
@settings(max_examples=80, deadline=None)
def test_shingles(rows):
    flat = np.array([x for r in rows for x in r], np.uint64)
    row = np.array([i for i, r in enumerate(rows) for _ in r], np.int64)
    sh, sr = shingles(flat, row, len(rows), 5)
    want = [(i, tuple(r[k:k + 5])) for i, r in enumerate(rows) if r for k in range(max(1, len(r) - 4))]
    assert sr.tolist() == [i for i, _ in want]
    names = {}
    for h, (_, w) in zip(sh.tolist(), want, strict=True):
        assert names.setdefault(w, h) == h
    full = {w: h for w, h in names.items() if len(w) == 5}
    assert len(set(full.values())) == len(full)


def test_chunks_cover_and_slices():
    arr = pa.array(["a" * 10, "", "b" * 50, "c", None, "d" * 5], pa.string()).fill_null("")
    parts = list(chunks(arr.slice(1), 20))
    assert parts[0][0] == 0 and parts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert list(chunks(pa.array([], pa.string()))) == []
