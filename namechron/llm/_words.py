"""Words of the contracts and their hashes, shared by the operators on word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes one Python worker keeps.
CACHE = 400_000


class WordHashes(dict):
    """word -> 64-bit hash that is the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of bytes other than space and U+0009 to U+000D, A-Z lower-cased on request."""
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash of each run of ``length`` words, put together from runs of doubled lengths."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, power, held = None, 0, hashes, 1
    while True:
        if length & held:
            factor = np.uint64(pow(base, held, 1 << 64))
            out = power[:n] if out is None else out * factor + power[have : have + n]
            have += held
        if have == length:
            return out
        factor = np.uint64(pow(base, held, 1 << 64))
        power = power[: len(power) - held] * factor + power[held:]
        held *= 2
