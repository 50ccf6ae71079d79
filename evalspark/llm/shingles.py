"""Word shingles of whole texts as 64-bit digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from . import common

PLACES = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F,
                   0x165667B19E3779F9, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
TEXT_SLICE = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Digests of words (A-Z lower-cased, cut at ASCII white space); up to
    ``remembered`` words are kept between texts."""

    def __init__(self, remembered: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.remembered = remembered

    def digests(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > self.remembered:
            known = self.known = {}
            new = set(words)
        digest = xxhash.xxh3_64_intdigest
        for w in new:
            known[w] = digest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[str | None], size: int, words: Words) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingles; a text with fewer words is one
    shingle, a text without words none."""
    for lo, hi in common.slices([t or "" for t in texts], TEXT_SLICE):
        lists = [words_of(t) for t in texts[lo:hi]]
        flat = words.digests([w for ws in lists for w in ws])
        rolled = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
        for k in range(size):
            rolled += flat[k : k + len(rolled)] * PLACES[k]
        rolled = mix(rolled)
        at = 0
        for ws in lists:
            n = len(ws)
            if n >= size:
                yield np.unique(rolled[at : at + n - size + 1])
            elif n:
                yield mix((flat[at : at + n] * PLACES[:n]).sum(keepdims=True) + np.uint64(n))
            else:
                yield np.empty(0, dtype=np.uint64)
            at += n
