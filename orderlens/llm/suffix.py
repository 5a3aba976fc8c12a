"""numpy half of the substring dedup: samples of a cover, and fingerprints of windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_U = np.uint64


@dataclass
class Powers:
    """Powers of the polynomial's base and of its inverse modulo 2**64, grown as needed."""

    up: np.ndarray
    down: np.ndarray

    @classmethod
    def of(cls, n: int) -> Powers:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        return cls(np.multiply.accumulate(up), np.multiply.accumulate(down))


_POWERS = [Powers.of(1 << 16)]


def powers(n: int) -> Powers:
    if len(_POWERS[0].up) < n:
        _POWERS[0] = Powers.of(1 << (n - 1).bit_length())
    return _POWERS[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefixes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes; a stretch's fingerprint follows from two of them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * powers(len(data) + 1).up[:len(data)], out=out[1:])
    return out


def fingerprints(sums: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Fingerprints of the stretches of ``length`` bytes from ``start``: equal bytes, equal fingerprints."""
    return (sums[start + length] - sums[start]) * powers(len(sums)).down[start]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` neighbours."""
    n = len(x) - w + 1
    pad = -len(x) % w
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def cover_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """The cover's samples in a block of texts, and the windows that each stands for.

    ``data`` is the texts' bytes, one after another, ``ends`` where each ends. Of the ``length - gram + 1``
    grams in a window of ``length`` bytes the one with the least hash (the first of equals) is the window's
    sample: two equal windows have equal samples at equal distances. Returns, for each run of
    neighbouring windows of a text with the same sample: first window, number of windows, sample
    position, the sample's fingerprint, and one of the run's whole stretch and its place in it.
    """
    w = length - gram + 1
    n = len(data)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    sums = prefixes(data)
    at = np.arange(n - gram + 1)
    h = mix(fingerprints(sums, at, gram))
    bits = _U(max(1, int(n).bit_length()))
    key = (h >> bits << bits) | at.astype(np.uint64)
    least = sliding_min(key, w)
    sample = (least & ((_U(1) << bits) - _U(1))).astype(np.int64)
    first = np.arange(len(sample))
    begin = np.concatenate([[0], ends[:-1]])
    text = np.repeat(np.arange(len(ends)), ends - begin)[:len(sample)]
    inside = first + length <= ends[text]
    change = np.flatnonzero((sample[1:] != sample[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])) + 1
    start = np.concatenate([[0], change])
    count = np.diff(np.concatenate([start, [len(sample)]]))
    ok = inside[start]
    start, count = start[ok], count[ok]
    spot = sample[start]
    whole = fingerprints(sums, start, count + length - 1)
    place = ((spot - start).astype(np.uint64) << _U(32)) | count.astype(np.uint64)
    return start, count, spot, h[spot], mix(whole ^ mix(place))
