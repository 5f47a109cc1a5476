"""Word shingles of whole texts as sets of 64-bit hashes, and their SuperMinHash signatures, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from .common import BLANKS

WORDS = 5
#: Bytes of text hashed at once; a longer text is hashed alone.
SLICE = 1 << 19
#: Rows taken out of an Arrow batch at once.
ROWS = 128
EMPTY = np.iinfo(np.uint64).max

_blank = np.zeros(256, bool)
_blank[[ord(c) for c in BLANKS]] = True
_random = np.random.default_rng(20240229)
_letter = _random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_place = _random.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        grown = max(n, SLICE + 4096)
        _powers = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(grown - 1, b, np.uint64)])) for b in (_BASE, _INVERSE))
    return _powers[0][:n], _powers[1]


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, number of words of each text); A-Z count as a-z, words end at ASCII white space."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    up, down = _powers_to(len(data))
    blank = _blank[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_letter[data] * up)])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, bounds), prepend=0)


def shingle_sets(texts: Sequence[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A shingle is `words` successive words; a text with fewer words has its whole sequence as the only
    one, and a text without words an empty set.
    """
    hashes, counts = word_hashes(texts)
    places = _place if words == WORDS else mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(hashes) - words + 1)
    grams = np.zeros(n, np.uint64)
    for at in range(words):
        grams += hashes[at : at + n] * places[at]
    grams = mix(grams)
    out, start = [], 0
    for count in counts.tolist():
        if count >= words:
            out.append(np.unique(grams[start : start + count - words + 1]))
        elif count:
            with np.errstate(over="ignore"):
                whole = (hashes[start : start + count] * places[:count]).sum(dtype=np.uint64)
            out.append(mix(np.array([whole + np.uint64(count)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        start += count
    return out


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts in UTF-8) in slices of bounded size; null counts as empty."""
    held, size, first = [], 0, 0
    for start in range(0, len(texts), ROWS):
        for row, data in enumerate(texts.slice(start, ROWS).cast(pa.binary()).to_pylist(), start):
            data = data or b""
            if held and size + len(data) > SLICE:
                yield first, held
                held, size, first = [], 0, row
            held.append(data)
            size += len(data) + 1
    if held:
        yield first, held


def super_min_hash(sets: Sequence[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (Ertl, 2017), one row of m values for each set.

    Every element draws a random permutation of the m places, step by step; at step j it offers j plus
    a fraction to its j-th place, and a place keeps the smallest offer. An offer of step j is larger
    than all of the steps before, so a set stops after the step that leaves none of its places empty:
    sets much larger than m need one step. The value is j in the bits from 48 up, the fraction below.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), m), EMPTY, np.uint64)
    if not sizes.sum():
        return out
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    flat = out.reshape(-1)
    fraction, place = _draw(elements, 0, m)
    np.minimum.at(flat, owner * m + place, fraction)
    open_sets = np.flatnonzero((out == EMPTY).any(axis=1) & (sizes > 0))
    ends = np.cumsum(sizes)
    for group in _in_groups(open_sets, sizes, 1 << 16):
        rows = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in group])
        _further_steps(elements[rows], owner[rows], place[rows], out, m)
    return out


def _draw(elements: np.ndarray, step: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The fraction and the place (from `step` to m - 1) that each element draws at a step."""
    bits = mix(elements + np.uint64((step + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    return bits >> np.uint64(16), step + ((bits & np.uint64(0xFFFF)) * np.uint64(m - step) >> np.uint64(16)).astype(np.int64)


def _in_groups(chosen: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    if len(chosen):
        cut = np.flatnonzero(np.diff(np.cumsum(sizes[chosen]) // most)) + 1
        yield from np.split(chosen, cut)


def _further_steps(elements: np.ndarray, owner: np.ndarray, place: np.ndarray, out: np.ndarray, m: int) -> None:
    order = np.tile(np.arange(m, dtype=np.int16), (len(elements), 1))
    row = np.arange(len(elements))
    order[row, place] = 0
    order[:, 0] = place
    flat = out.reshape(-1)
    for step in range(1, m):
        unfilled = (out[owner_ids := np.unique(owner[row])] == EMPTY).any(axis=1)
        row = row[np.isin(owner[row], owner_ids[unfilled])]
        if not len(row):
            return
        fraction, place = _draw(elements[row], step, m)
        taken = order[row, place]
        order[row, place] = order[row, step]
        order[row, step] = taken
        np.minimum.at(flat, owner[row] * m + taken, fraction + np.uint64(step << 48))


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` values; the band's number is part of the key."""
    bands = signatures.shape[1] // rows
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signatures), bands)).copy()
    for at in range(rows):
        keys = mix(keys * _BASE + parts[:, :, at])
    return keys
