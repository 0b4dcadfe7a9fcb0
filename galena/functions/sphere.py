"""Cells of a space-filling curve on the sphere, vectorised with numpy.

A point is put on the unit sphere in the cube [-1, 1]^3 and each axis is cut into 2^21 steps; the bits of the
three steps, interleaved, are the point's code. All points of a cell of side 2^(1-level) have the same first
3*level bits, so a cell is a range of codes. Three axes need no special case at the poles or at 180 degrees."""

from __future__ import annotations

import numpy as np

EARTH_M = 6_371_000.0
BITS = 21


def interleave(x: np.ndarray) -> np.ndarray:
    """The 21 low bits of x, two free bits after each."""
    x = x.astype(np.int64)
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        x = (x | (x << shift)) & mask
    return x


def unit_xyz(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """(3, n) coordinates on the unit sphere; any real degrees, as in the haversine formula."""
    p, q = np.radians(lat), np.radians(lon)
    c = np.cos(p)
    return np.stack([c * np.cos(q), c * np.sin(q), np.sin(p)])


def point_codes(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """The code of each point at the full 63 bits."""
    s = np.clip(np.floor((unit_xyz(lat, lon) + 1) * (1 << (BITS - 1))), 0, (1 << BITS) - 1).astype(np.int64)
    return (interleave(s[0]) << 2) | (interleave(s[1]) << 1) | interleave(s[2])


def cover_level(radius_m: float) -> int:
    """The finest level of which a cell is at least as wide as the radius."""
    return int(np.clip(np.floor(np.log2(2 * EARTH_M / max(radius_m, 1e-2))), 1, BITS))


def cover_discs(lat: np.ndarray, lon: np.ndarray, radius_m: float, level: int, bucket_level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of codes that cover discs of one radius: (index of the disc, first code, last code). Neighbouring
    cells are joined into one range, but no range leaves its cell of bucket_level."""
    v, n = unit_xyz(lat, lon), len(lat)
    chord = 2 * np.sin(min(radius_m / (2 * EARTH_M), np.pi / 2)) + 1e-9
    half, top = float(1 << (level - 1)), (1 << level) - 1
    lo = np.clip(np.floor((v - chord + 1) * half), 0, top).astype(np.int64)
    hi = np.clip(np.floor((v + chord + 1) * half), 0, top).astype(np.int64)
    free = 3 * (BITS - level)
    none = np.iinfo(np.int64).max
    cells = []
    wide = (hi - lo).max(axis=1) + 1 if n else np.zeros(3, int)
    for dx in range(wide[0]):
        for dy in range(wide[1]):
            for dz in range(wide[2]):
                c = lo + np.array([[dx], [dy], [dz]])
                a, b = c / half - 1, (c + 1) / half - 1
                off = np.maximum(np.maximum(a - v, v - b), 0)
                far, near = np.maximum(a * a, b * b).sum(0), np.where(a * b < 0, 0, np.minimum(a * a, b * b)).sum(0)
                ok = (c <= hi).all(0) & ((off * off).sum(0) <= chord * chord) & (near <= 1 + 1e-9) & (far >= 1 - 1e-9)
                code = (interleave(c[0]) << 2) | (interleave(c[1]) << 1) | interleave(c[2])
                cells.append(np.where(ok, code, none))
    if not cells:
        e = np.zeros(0, np.int64)
        return e, e, e
    m = np.sort(np.stack(cells, axis=1), axis=1)
    real = m < none
    up = 3 * (level - bucket_level)
    joined = np.zeros_like(real)
    joined[:, 1:] = real[:, 1:] & (m[:, 1:] - 1 == m[:, :-1]) & (m[:, 1:] >> up == m[:, :-1] >> up)
    first = real & ~joined
    last = real.copy()
    last[:, :-1] &= ~joined[:, 1:]
    at = np.nonzero(first)
    return at[0], m[at] << free, ((m[np.nonzero(last)] + 1) << free) - 1


def haversine_m(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle distance in metres."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.clip(a, 0, 1)))
