"""XXH64 of many byte spans of one buffer at a time.

Spans are grouped by length, so that every step of the published algorithm
is one numpy operation over a whole group; the few very long spans go
through the ``xxhash`` package one by one.
"""

from __future__ import annotations

import numpy as np
import xxhash

U64 = np.uint64
_P1, _P2, _P3, _P4, _P5 = (
    U64(11400714785074694791),
    U64(14029467366897019727),
    U64(1609587929392839161),
    U64(9650029242287828579),
    U64(2870177450012600261),
)
LONG_SPAN = 160


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def _lane(acc: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _rotate(acc + value * _P2, 31) * _P1


def xxh64_spans(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of ``buf[s : s + n]`` for every span."""
    out = np.empty(len(starts), U64)
    if not len(starts):
        return out
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint16)
    two = (padded[:-1] | (padded[1:] << np.uint16(8))).astype(np.uint32)
    four = (two[:-2] | (two[2:] << np.uint32(16))).astype(U64)
    eight = four[:-4] | (four[4:] << U64(32))
    capped = np.minimum(lengths, LONG_SPAN + 1).astype(np.uint8 if LONG_SPAN < 255 else np.int64)
    order = np.argsort(capped, kind="stable")
    cuts = np.flatnonzero(np.diff(capped[order])) + 1
    raw = None
    with np.errstate(over="ignore"):
        for group in np.split(order, cuts):
            n = int(lengths[group[0]])
            if n > LONG_SPAN:
                raw = raw or buf.tobytes()
                for i in group:
                    s = int(starts[i])
                    out[i] = xxhash.xxh64_intdigest(raw[s : s + int(lengths[i])], seed)
                continue
            out[group] = _equal_length(buf, four, eight, starts[group], n, seed)
    return out


def _equal_length(buf, four, eight, at, n: int, seed: int) -> np.ndarray:
    s = U64(seed)
    done = 0
    if n >= 32:
        acc = [np.full(len(at), s + _P1 + _P2, U64), np.full(len(at), s + _P2, U64),
               np.full(len(at), s, U64), np.full(len(at), s - _P1, U64)]
        while n - done >= 32:
            for k in range(4):
                acc[k] = _lane(acc[k], eight[at + (done + 8 * k)])
            done += 32
        h = _rotate(acc[0], 1) + _rotate(acc[1], 7) + _rotate(acc[2], 12) + _rotate(acc[3], 18)
        for a in acc:
            h = (h ^ _lane(np.zeros(len(at), U64), a)) * _P1 + _P4
    else:
        h = np.full(len(at), s + _P5, U64)
    h = h + U64(n)
    while n - done >= 8:
        h = _rotate(h ^ _lane(np.zeros(len(at), U64), eight[at + done]), 27) * _P1 + _P4
        done += 8
    if n - done >= 4:
        h = _rotate(h ^ (four[at + done] * _P1), 23) * _P2 + _P3
        done += 4
    while done < n:
        h = _rotate(h ^ (buf[at + done].astype(U64) * _P5), 11) * _P1
        done += 1
    h = (h ^ (h >> U64(33))) * _P2
    h = (h ^ (h >> U64(29))) * _P3
    return h ^ (h >> U64(32))
