"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd

WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, from the golden ratio
FINAL = np.uint64(0xD6E8FEB86659FD93)  # odd multiplier of a published 64-bit finaliser
S32 = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> S32)) * FINAL
    x = (x ^ (x >> S32)) * FINAL
    return x ^ (x >> S32)


def shingle_sets(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: lower-cased words, ``size`` in a row.

    A text of 1 to ``size - 1`` words has one shingle of all of them; one without a word none.
    """
    words = [WORD.findall(t.lower()) for t in texts]
    flat = [w for ws in words for w in ws]
    h = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.empty(0, "uint64")
    out, at = [], 0
    for ws in words:
        own = h[at : at + len(ws)]
        at += len(ws)
        n = max(1, len(own) - size + 1) if len(own) else 0
        x = np.full(n, np.uint64(size), "uint64")
        for k in range(min(size, len(own))):
            x = x * MIX + own[k : k + n]
        out.append(np.unique(mix(x)))
    return out
