"""Arrays of hashes over bytes and words, without a loop per byte or word."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_CODES = np.random.default_rng(7).integers(1, 2**63, 256).astype(U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(n, base, U)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        have = _POWERS[0] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of MurmurHash3: every bit of the result depends on every bit of x."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def running(symbols: np.ndarray) -> np.ndarray:
    """c with c[i] the polynomial of the first i symbols."""
    out = np.empty(len(symbols) + 1, U)
    out[0] = 0
    np.cumsum(symbols * _powers(len(symbols))[0][: len(symbols)], out=out[1:])
    return out


def of_spans(c: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((c[ends] - c[starts]) * _powers(len(c))[1][starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def of_grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols from each position on; len(symbols) - k + 1 of them."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.empty(0, U)
    c = running(symbols)
    return mix((c[k:] - c[:-k]) * _powers(len(c))[1][:n])


def byte_symbols(buf: np.ndarray) -> np.ndarray:
    return _BYTE_CODES[buf]


def word_spans(buf: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not white."""
    gap = np.ones(len(buf) + 2, bool)
    gap[1:-1] = white[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


def word_symbols(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return of_spans(running(byte_symbols(buf)), starts, ends)


def slide(x: np.ndarray, w: int, f: np.ufunc, fill: int) -> np.ndarray:
    """f over each w consecutive items of x (len(x) - w + 1 results), in time that does not depend on w."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    y = np.full(-(-len(x) // w) * w, fill, x.dtype)
    y[: len(x)] = x
    y = y.reshape(-1, w)
    ahead = f.accumulate(y, axis=1).ravel()
    back = f.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return f(back[:n], ahead[w - 1 : w - 1 + n])


def winnow(grams: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """Positions of grams that are a minimum (all of them, if tied) of a valid window.

    grams: hash at each position. valid[s]: the w grams from s on are in one
    document. Equal windows select at equal places, wherever they stand.
    """
    low = slide(grams, w, np.minimum, 2**64 - 1)
    low = np.where(valid[: len(low)], low, U(0))
    if not len(low):
        return np.empty(0, np.int64)
    wide = np.zeros(len(grams) + w - 1, U)
    wide[w - 1 : w - 1 + len(low)] = low
    return np.flatnonzero((slide(wide, w, np.maximum, 0) == grams) & (grams > 0))


_P1, _P2, _P3, _P4, _P5 = (U(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def xxh64(buf: bytes, starts: np.ndarray, lens: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many spans of buf at once, in slices that fit the cache."""
    padded = buf + bytes(40)
    step = 1 << 14
    with np.errstate(over="ignore"):
        parts = [_xxh64(padded, starts[i : i + step], lens[i : i + step], U(seed)) for i in range(0, len(starts), step)]
    return np.concatenate(parts) if parts else np.empty(0, U)


def _xxh64(padded: bytes, starts: np.ndarray, lens: np.ndarray, seed: U) -> np.ndarray:
    n = len(padded) - 8
    at8 = np.ndarray((n,), "<u8", padded, strides=(1,))
    at4 = np.ndarray((n,), "<u4", padded, strides=(1,))
    at1 = np.frombuffer(padded, np.uint8)
    h = np.full(len(starts), seed + _P5, U)
    p = starts.astype(np.int64)
    left = lens.astype(np.int64)
    i = np.flatnonzero(left >= 32)
    if len(i):
        q, rest = p[i], left[i]
        v = [np.full(len(i), x, U) for x in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
        live = np.arange(len(i))
        while len(live):
            for j in range(4):
                v[j][live] = _rotl(v[j][live] + at8[q[live] + 8 * j] * _P2, 31) * _P1
            q[live] += 32
            rest[live] -= 32
            live = live[rest[live] >= 32]
        acc = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for j in range(4):
            acc = (acc ^ (_rotl(v[j] * _P2, 31) * _P1)) * _P1 + _P4
        h[i], p[i], left[i] = acc, q, rest
    h += lens.astype(U)
    for _ in range(3):
        has = left >= 8
        h = np.where(has, _rotl(h ^ (_rotl(at8[p] * _P2, 31) * _P1), 27) * _P1 + _P4, h)
        p += has << 3
        left -= has << 3
    has = left >= 4
    h = np.where(has, _rotl(h ^ (at4[p].astype(U) * _P1), 23) * _P2 + _P3, h)
    p += has << 2
    left -= has << 2
    for _ in range(3):
        has = left > 0
        h = np.where(has, _rotl(h ^ (at1[p].astype(U) * _P5), 11) * _P1, h)
        p += has
        left -= has
    h ^= h >> U(33)
    h *= _P2
    h ^= h >> U(29)
    h *= _P3
    return h ^ (h >> U(32))
