"""The perfect binary Golay code (23, 12, 7) as a fuzzy hash.

Every 23-bit word lies within three bits of exactly one codeword. The keys of a word are the indices
of the codewords nearest to the word itself and to its 23 neighbours: one key for a word within two
bits of its codeword, six for a word at three bits. Two words that differ in at most two bits have a
word in common within one bit of both, and so a key.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
CHECK = LENGTH - DATA
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
FLIPS = np.array([0, *(1 << i for i in range(LENGTH))], dtype=np.int64)


def remainder(word: int) -> int:
    """The word modulo the generator polynomial: its syndrome."""
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the three bytes of a word (3 x 256), and the error pattern of each syndrome."""
    single = [remainder(1 << i) for i in range(LENGTH)] + [0]
    syndromes = np.zeros((3, 256), dtype=np.int64)
    for byte in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1:
                    syndromes[byte, value] ^= single[byte * 8 + bit]
    errors = np.zeros(1 << CHECK, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            pattern = sum(1 << b for b in bits)
            errors[remainder(pattern)] = pattern
    return syndromes, errors


def decode(words: np.ndarray) -> np.ndarray:
    """The index (the twelve data bits) of the nearest codeword of each word."""
    syndromes, errors = tables()
    syndrome = (
        syndromes[0][words & 255] ^ syndromes[1][words >> 8 & 255] ^ syndromes[2][words >> 16 & 127]
    )
    return (words ^ errors[syndrome]) >> CHECK


def keys(words: np.ndarray) -> np.ndarray:
    """For each word a row of 24 indices: its own, and those of its neighbours."""
    return decode(words[:, None] ^ FLIPS[None, :])
