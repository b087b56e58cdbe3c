"""Words and word n-grams of whole batches of texts as numpy arrays.

A word is a maximal run of digits, letters and non-ASCII characters after
lower-casing A-Z, the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Every byte
of a non-ASCII character is 0x80 or more, so bytes decide it exactly.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

MASK = (1 << 64) - 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
STEP = np.uint64(0x9E3779B97F4A7C15)
GRAM = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
#: Masks of the first 0 to 8 bytes of a little-endian 64-bit value.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words of more bytes are digested instead of folded eight bytes at a time.
LONG_WORD = 256


class Words:
    """Words of texts laid end to end: ``hash`` by word, ``first`` the index
    of each text's first word (one more entry for the end).

    A word of up to eight bytes is hashed without loss; a longer one is folded
    eight bytes at a time through a mixing that is not linear, a very long one
    digested: words made of a few repeated parts are as safe as any."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = LOWER[data]
        is_word = IS_WORD[low]
        cut = np.zeros(len(data) + 1, bool)
        cut[off] = True
        before = np.empty_like(is_word)
        before[:1], before[1:] = False, is_word[:-1]
        self.start = np.flatnonzero(is_word & (~before | cut[:-1]))
        after = np.empty_like(is_word)
        after[-1:], after[:-1] = False, is_word[1:]
        end = np.flatnonzero(is_word & (~after | cut[1:])) + 1
        self.size = end - self.start
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.low = low
        if not len(self.start):
            self.hash = np.zeros(0, np.uint64)
            return
        padded = np.concatenate([low, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(low) + 1,), "<u8", padded, strides=(1,))
        self.hash = mix(eight[self.start] & FIRST[np.minimum(self.size, 8)])
        more = np.flatnonzero((self.size > 8) & (self.size <= LONG_WORD))
        done = 8
        while len(more):
            left = np.minimum(self.size[more] - done, 8)
            self.hash[more] = mix(self.hash[more] * GRAM + (eight[self.start[more] + done] & FIRST[left]))
            done += 8
            more = more[self.size[more] > done]
        for i in np.flatnonzero(self.size > LONG_WORD):
            word = low[self.start[i]:self.start[i] + self.size[i]].tobytes()
            self.hash[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")

    def window(self, i: int, n: int) -> bytes:
        """The n words from ``i`` on, one zero byte between them."""
        return b"\0".join(self.low[a:a + k].tobytes() for a, k in zip(self.start[i:i + n].tolist(), self.size[i:i + n].tolist(), strict=True))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that would cross the
        batch's end are left out, those that cross a text's end are there."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return self.gram(lambda j: self.hash[j:n + j], k)

    def gram_at(self, at: np.ndarray, k: int) -> np.ndarray:
        return self.gram(lambda j: self.hash[at + j], k)

    @staticmethod
    def gram(word, k: int) -> np.ndarray:
        acc = mix(word(0) + np.uint64(k))
        for j in range(1, k):
            acc = mix(acc * GRAM + word(j))
        return acc

    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.count)), self.count)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text; a text of fewer
    words, but not none, has one shingle of all its words."""
    w = Words(data, off)
    g = w.grams(k)
    out = []
    for a, b in zip(w.first.tolist(), w.first[1:].tolist(), strict=False):
        if b - a >= k:
            s = np.sort(g[a:b - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(w.gram_at(np.array([a]), b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
