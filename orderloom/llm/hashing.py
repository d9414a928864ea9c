"""64-bit hashes of byte strings, worked out for all places of an array at once.

``stretch_hashes`` are cheap and good enough to choose places by, but not to tell strings apart: modulo a power of two,
some strings made for it (or by nature, as two letters in turn by the Thue-Morse rule) get the same one whatever the
factor. ``polynomials`` are taken modulo the prime 2 ** 61 - 1 at a random base: two different strings of n bytes get
the same one for n bases in 2 ** 61 at most.
"""

from __future__ import annotations

import numpy as np

# The hash of bytes b0 b1 .. is the sum of T[b_i] * F ** i modulo 2 ** 64 for a random table T and an odd F. As F has
# an inverse, running sums give the hash of any stretch.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_powers_of: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits well spread."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, np.uint64, endpoint=False)


_TABLE = random_words(11, 256)


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _powers_of or len(_powers_of[base]) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _powers_of[base] = np.multiply.accumulate(out, out=out)
    return _powers_of[base][:n]


def running_sums(data: np.ndarray) -> np.ndarray:
    """Sums of the weighted bytes before each place, one more than there are bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers(_FACTOR, len(data)), out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each stretch of the bytes that ``sums`` was made from."""
    own = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(sums))[starts]
    return mixed(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_PRIME = np.uint64((1 << 61) - 1)
_BASE = int(random_words(53, 1)[0] % _PRIME)
_LOW30, _LOW31 = np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_S30, _S31, _S61 = np.uint64(30), np.uint64(31), np.uint64(61)
_prime_powers: dict[int, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit number modulo the prime."""
    x = (x & _PRIME) + (x >> _S61)
    return np.where(x >= _PRIME, x - _PRIME, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, by halves of 30 and 31 bits: 2 ** 61 is one."""
    a1, a0, b1, b0 = a >> _S31, a & _LOW31, b >> _S31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(_reduced(np.uint64(2) * a1 * b1 + (middle >> _S30) + ((middle & _LOW30) << _S31)) + _reduced(a0 * b0))


def _powers_mod(base: int, n: int) -> np.ndarray:
    if base not in _prime_powers or len(_prime_powers[base]) < n:
        out = np.ones(1, np.uint64)
        while len(out) < max(n, 1 << 16):
            step = np.uint64(pow(base, len(out), int(_PRIME)))
            out = np.concatenate((out, _product(out, step)))
        _prime_powers[base] = out
    return _prime_powers[base][:n]


def polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each stretch of the bytes: a polynomial in a random base modulo a prime, its bits well spread."""
    code, power = data.astype(np.uint64) + np.uint64(1), _powers_mod(_BASE, len(data))
    high = code * (power >> _S31)
    term = _reduced(code * (power & _LOW31) + (high >> _S30) + ((high & _LOW30) << _S31))
    sums = np.zeros(len(data) + 1, np.uint64)
    # Halves apart, so that running sums stay below 64 bits.
    tops, lows = np.cumsum(term >> _S31), np.cumsum(term & _LOW31)
    sums[1:] = _reduced((tops >> _S30) + ((tops & _LOW30) << _S31) + lows)
    between = _reduced(sums[ends] + _PRIME - sums[starts])
    inverse = _powers_mod(pow(_BASE, -1, int(_PRIME)), len(data) + 1)
    return mixed(_product(between, inverse[starts]) + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
