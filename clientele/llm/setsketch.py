"""SetSketch registers of shingle sets, and the joint likelihood estimate.

A register is a truncated, exponentially spaced minimum: over the elements of a
set an exponential variate per register is drawn from a hash, and the register
holds ``floor(1 - log_b(minimum))`` cut to ``[0, q + 1]``.  Registers of a union
are the larger of the registers of its parts.  With a base close to 1 two sets
agree in a register with a probability close to their Jaccard similarity, and
unrelated sets hardly ever, so bands of registers work as locality-sensitive
keys.
"""

from __future__ import annotations

import numpy as np
import xxhash

BASE = 1.001
RATE = 20.0
TOP = 2**16 - 2  # q: registers fit two bytes
REGISTER = np.dtype("<u2")
BANDS = 40
ROWS_PER_BAND = 4  # four registers make one 64-bit key
REGISTERS = BANDS * ROWS_PER_BAND
SHINGLE_WORDS = 5
_CHUNK = 512
# Variates of one chunk of elements, room that is used again by every set.
_VARIATES = np.empty((_CHUNK, REGISTERS), dtype=np.uint64)

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RANDOM = np.random.default_rng(20240229)
_PLACES = _RANDOM.integers(0, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text.

    A-Z are lower-cased; bytes.split cuts at exactly the six separators of words.
    A text of one to four words has its whole sequence as one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    width = min(SHINGLE_WORDS, len(hashes))
    n = len(hashes) - width + 1
    joined = np.full(n, np.uint64(width))
    for k in range(width):
        joined += mixed(hashes[k:k + n] * _PLACES[k])
    elements = mixed(joined)
    elements.sort()
    return elements[np.diff(elements, prepend=~elements[:1]) != 0]


def registers(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes; all zero for the empty set."""
    if not len(elements):
        return np.zeros(REGISTERS, dtype=REGISTER)
    # The smallest exponential variate belongs to the largest uniform one.
    highest = np.zeros(REGISTERS, dtype=np.uint64)
    for start in range(0, len(elements), _CHUNK):
        chunk = elements[start:start + _CHUNK, None]
        part = np.multiply(chunk, _FACTORS, out=_VARIATES[:len(chunk)])
        part += _SHIFTS
        np.maximum(highest, part.max(axis=0), out=highest)
    below_one = (np.float64(2.0**64) - highest.astype(np.float64)).clip(min=1) / 2.0**64
    least = -np.log1p(-below_one.clip(max=1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP + 1).astype(REGISTER)


def band_keys(register_rows: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, from its number and its four registers."""
    packed = np.ascontiguousarray(register_rows).view("<u8")
    return mixed(packed ^ mixed(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


def unpacked(column) -> np.ndarray:
    """A matrix of registers from an iterable of their bytes."""
    return np.frombuffer(b"".join(column), REGISTER).reshape(-1, REGISTERS)


def _likelihood(j, larger, smaller, equal, share_a, share_b) -> np.ndarray:
    """Log likelihood of similarities ``j``, a concave function of them."""
    def above(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    p = above((share_a - share_b * j).clip(1e-12, 1))
    m = above((share_b - share_a * j).clip(1e-12, 1))
    return larger * np.log(p) + smaller * np.log(m) + equal * np.log((1 - p - m).clip(1e-12, 1))


def estimate_jaccard(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray,
                     n_first: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """Maximum likelihood similarity of pairs of sets of known sizes.

    ``larger``, ``smaller`` and ``equal`` count the registers in which the first
    set is above, below and level with the second.
    """
    share_a = n_first / (n_first + n_second)
    share_b = 1 - share_a

    def likelihood(j):
        return _likelihood(j, larger, smaller, equal, share_a, share_b)

    low, high = np.zeros(len(equal)), np.minimum(share_a / share_b, share_b / share_a)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(24):
        left, right = high - golden * (high - low), low + golden * (high - low)
        rising = likelihood(left) < likelihood(right)
        low, high = np.where(rising, left, low), np.where(rising, high, right)
    return (low + high) / 2


def reaches(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray, least: float) -> np.ndarray:
    """Whether the estimates of pairs given as rows of registers are ``least`` or more, up to 1e-4.

    The likelihood is concave: its maximum is not below a place that it still rises to.
    """
    larger, smaller = (first > second).sum(axis=1), (first < second).sum(axis=1)
    equal = first.shape[1] - larger - smaller
    share_a = n_first / (n_first + n_second)
    share_b = 1 - share_a
    counts = (larger, smaller, equal, share_a, share_b)
    most = np.minimum(share_a / share_b, share_b / share_a)
    return (most >= least) & (_likelihood(least, *counts) >= _likelihood(least - 1e-4, *counts))


def equal_registers(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """In how many registers each row of ``first`` equals each row of ``second``."""
    same = (first[:, None, :] == second[None, :, :]).view(np.uint64)
    # Eight counts a word, none of which passes 255; the product adds them up in the top byte.
    return ((same.sum(axis=2, dtype=np.uint64) * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def estimate_rows(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """Estimates for pairs given as rows of registers."""
    return estimate_jaccard(
        (first > second).sum(axis=1), (first < second).sum(axis=1), (first == second).sum(axis=1),
        n_first.astype(float), n_second.astype(float),
    )
