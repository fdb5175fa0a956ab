"""Words of long texts in bounded memory: spans over a whole column, hashes piece by piece.

``Text.hash`` holds eight bytes of running sums per byte of text. Here the sums cover ``PIECE`` bytes at
a time (cut between words), so a text of any length costs its words' spans and hashes only.
"""

from __future__ import annotations

import numpy as np

from .textnum import Text

PIECE = 1 << 20


def word_hashes(text: Text, starts: np.ndarray, ends: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """The hashes ``Text.hash`` gives for the spans, with running sums of about ``piece`` bytes at a time."""
    if len(text.data) <= piece or not len(starts):
        return text.hash(starts, ends)
    out = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(text.data), piece)), len(starts)))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        part, base = Text.__new__(Text), int(starts[lo])
        part.n, part._sum = 1, None
        part.data = text.data[base : int(ends[hi - 1])]
        part.offsets = np.array([0, len(part.data)], np.int64)
        out[lo:hi] = part.hash(starts[lo:hi] - base, ends[lo:hi] - base)
    return out
