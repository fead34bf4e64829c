"""Plain forms of what the tests compare with."""

import hashlib

import numpy as np


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """Every run by its definition: each lag's longest stretches, kept if no smaller period holds."""
    out, n = [], len(words)
    ids = np.unique(np.array(words, object), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // 4 + 1):
        odd = np.concatenate([[-1], np.flatnonzero(ids[q:] != ids[:-q]), [n - q]])
        for k in np.flatnonzero(np.diff(odd) > max(6 - q, 3 * q)):
            i, j = int(odd[k]) + 1, int(odd[k + 1]) + q
            stretch = ids[i:j]
            if not any((stretch[p:] == stretch[:-p]).all() for p in range(1, q)):
                out.append((i, j - i, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]
