"""Distinct word shingles of whole texts as 64-bit hashes, computed on the bytes of an Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from cargolens.llm.mixing import scramble

#: Bytes of text hashed in one go; a longer text is one go of its own.
GO = 1 << 20
_U = np.uint64
_random = np.random.Generator(np.random.PCG64(5))
#: A number per byte, and the odd base of the rolling sums with its inverse modulo 2**64.
BYTES = _random.integers(0, 1 << 64, 256, np.uint64)
BASE = int(_random.integers(0, 1 << 63)) * 2 + 1
INVERSE = pow(BASE, -1, 1 << 64)
#: An odd factor per place in a shingle.
PLACES = _random.integers(0, 1 << 63, 64, np.uint64) * _U(2) + _U(1)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Sets:
    """Shingle sets of some documents: ``hashes[bounds[k]:bounds[k+1]]`` is the sorted set of document ``first + k``."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.sizes)

    def keys(self) -> np.ndarray:
        """A 64-bit key of each set: equal sets have equal keys."""
        with np.errstate(over="ignore"):
            sums = np.concatenate([[_U(0)], np.cumsum(scramble(self.hashes + PLACES[-1]), dtype=np.uint64)])
            return scramble(sums[self.bounds[1:]] - sums[self.bounds[:-1]] + self.sizes.astype(np.uint64)).view(np.int64)


def powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    filled = 1
    with np.errstate(over="ignore"):
        while filled < count:
            step = min(filled, count - filled)
            out[filled : filled + step] = out[:step] * _U(pow(base, filled, 1 << 64))
            filled += step
    return out


_powers: dict[str, np.ndarray] = {}


def power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < count:
        _powers["up"], _powers["down"] = powers(BASE, count), powers(INVERSE, count)
    return _powers["up"], _powers["down"]


def of_texts(texts: pa.Array, size: int) -> Iterator[Sets]:
    """Sets of the documents of one string column (null: empty), in runs of about ``GO`` bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + GO, "right")) - 1)
        yield of_bytes(data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at], at, size)
        at = stop


def of_bytes(raw: np.ndarray, offsets: np.ndarray, first: int, size: int) -> Sets:
    docs = len(offsets) - 1
    inside = ~BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | edge[1:])) + 1 if len(raw) else starts
    up, down = power_tables(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[_U(0)], np.cumsum(BYTES[LOWER[raw]] * up[: len(raw)], dtype=np.uint64)])
        word = scramble((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        owner = np.searchsorted(offsets, starts, "right") - 1
        counts = np.bincount(owner, minlength=docs)
        place = np.arange(len(word)) - np.concatenate([[0], np.cumsum(counts)[:-1]])[owner]
        # Full shingles start where enough words follow; a shorter text is one shingle of all its words.
        full = np.flatnonzero(counts[owner] - place >= size)
        grams = np.zeros(len(full), np.uint64)
        for k in range(size):
            grams += word[full + k] * PLACES[k]
        short = np.flatnonzero(counts[owner] < size)
        whole = np.zeros(docs, np.uint64)
        np.add.at(whole, owner[short], word[short] * PLACES[place[short]])
        brief = np.flatnonzero((counts > 0) & (counts < size))
        grams = scramble(np.concatenate([grams, whole[brief] + counts[brief].astype(np.uint64)]))
    owners = np.concatenate([owner[full], brief])
    order = np.lexsort((grams, owners))
    grams, owners = grams[order], owners[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
    grams, owners = grams[new], owners[new]
    return Sets(first, grams, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=docs))]).astype(np.int64))
