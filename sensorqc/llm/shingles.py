"""Word shingles as 64-bit hashes, computed batch by batch with numpy."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """Word to 64-bit hash; forgets everything when it has grown too large."""

    limit = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return h


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    acc = np.full(len(parts[0]), 0x243F6A8885A308D3, np.uint64)
    for p in parts:
        acc = (acc ^ p) * _MIX
        acc ^= acc >> _SHIFT
    return acc


def shingle_set(text: bytes, k: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes (int64) of the k-word shingles of a text whose A-Z are lowered.

    Fewer than k words make one shingle of them all; no words make none.
    """
    tokens = text.lower().split()  # on bytes, lower() touches A-Z only
    if not tokens:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = len(h) - k + 1
    parts = [h[j : j + n] for j in range(k)] if n > 0 else [h[j : j + 1] for j in range(len(h))]
    with np.errstate(over="ignore"):
        return np.unique(_fold(parts).view(np.int64))


def set_key(tokens: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def min_hashes(tokens: np.ndarray, rounds: int) -> list[int]:
    with np.errstate(over="ignore"):
        u = tokens.view(np.uint64)
        return [int(((u ^ (u >> np.uint64(31))) * np.uint64(2 * (i * 0x1B873593 + 0xCC9E2D51) + 1)).min().view(np.int64)) for i in range(rounds)]


def parity_sketch(tokens: np.ndarray, bits: int) -> list[int]:
    """``bits`` / 64 words: a bit is set if an odd number of tokens fall on it.

    The sketches of two sets differ in at most as many bits as the sets differ in tokens.
    """
    with np.errstate(over="ignore"):
        at = (tokens.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(65 - bits.bit_length())
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()
