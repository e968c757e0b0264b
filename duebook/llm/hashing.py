"""Vectorised 64-bit hashes of many slices of a byte string."""

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)
_TABLE = np.random.default_rng(20260101).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return _TABLE[data]


def _powers(kind: str, n: int) -> np.ndarray:
    if len(_POWERS[kind]) < n:
        steps = np.full(max(n, 2 * len(_POWERS[kind]), 65536), _ODD if kind == "up" else _INVERSE, dtype=np.uint64)
        steps[0] = 1
        _POWERS[kind] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[kind]


def slices(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of raw[start:end] for each pair; equal slices have equal hashes wherever they are."""
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(byte_values(np.frombuffer(raw, dtype=np.uint8)) * _powers("up", len(raw) + 1)[: len(raw)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * _powers("down", len(raw) + 1)[starts])
