"""Elias-Fano coding of non-decreasing numbers, and a two-level trie of quantised values built from it."""

from __future__ import annotations

import mmap
from dataclasses import dataclass

import numpy as np

CONTEXT_BITS = SUCCESSOR_BITS = 20
# Successors are coded in blocks of so many, so that a search decodes only the blocks it needs.
BLOCK = 1 << 16
# Counts up to here are exact; above, the code is logarithmic.
EXACT, RATIO = 4096, 1.001


def quantise(counts: np.ndarray) -> np.ndarray:
    """16-bit codes of counts on a logarithmic scale; 0 is absent."""
    high = EXACT + np.log(np.maximum(counts, EXACT) / EXACT) / np.log(RATIO)
    return np.where(counts <= EXACT, counts, np.minimum(np.rint(high), 65535)).astype(np.uint16)


def value_of(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.float64)
    return np.where(x <= EXACT, x, EXACT * RATIO ** (x - EXACT))


def encode(values: np.ndarray) -> bytes:
    """Each number is cut into low bits, packed, and a high part, written in unary."""
    n = len(values)
    if not n:
        return np.array([0, 0, 0], np.int64).tobytes()
    first = int(values[0])
    rest = values.astype(np.int64) - first
    low = max(0, int(np.floor(np.log2(max(1, int(rest[-1]) // n)))))
    head = np.array([n, low, first], np.int64).tobytes()
    bits = ((rest[:, None] >> np.arange(low)) & 1).astype(np.uint8) if low else np.zeros((n, 0), np.uint8)
    unary = np.zeros(int(rest[-1] >> low) + n, np.uint8)
    unary[(rest >> low) + np.arange(n)] = 1
    return head + np.packbits(bits.ravel()).tobytes() + np.packbits(unary).tobytes()


def decode(data: np.ndarray) -> np.ndarray:
    n, low, first = data[:24].view(np.int64)
    if not n:
        return np.zeros(0, np.int64)
    middle = 24 + (n * low + 7) // 8
    bits = np.unpackbits(data[24:middle], count=n * low).reshape(n, low)
    high = np.flatnonzero(np.unpackbits(data[middle:]))[:n] - np.arange(n)
    out = high << low
    for k in range(low):
        out |= bits[:, k].astype(np.int64) << k
    return out + first


@dataclass
class Trie:
    """Contexts, a pointer from each to its successors, and the successors with a quantised value.

    A key has CONTEXT_BITS of context and SUCCESSOR_BITS of a number that is relative to the context. Pointers and successors are
    Elias-Fano coded; successors are made non-decreasing by the context they follow. All levels lie in one memory map.
    """

    memory: np.ndarray
    pointers: tuple[int, int]
    blocks: list[tuple[int, int]]
    values: tuple[int, int]

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> Trie:
        """From distinct keys in order."""
        pointers = encode(np.searchsorted(keys >> SUCCESSOR_BITS, np.arange((1 << CONTEXT_BITS) + 1)))
        parts = [pointers, *(encode(keys[i : i + BLOCK]) for i in range(0, len(keys), BLOCK)), quantise(counts).tobytes()]
        # Levels start at multiples of eight bytes.
        places, end = [], 0
        for p in parts:
            places.append((end, end + len(p)))
            end += -(-len(p) // 8) * 8
        held = mmap.mmap(-1, max(end, 8))
        for p, (a, b) in zip(parts, places, strict=True):
            held[a:b] = p
        return cls(np.frombuffer(held, np.uint8), places[0], places[1:-1], places[-1])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Codes of sorted keys, 0 for those that are absent: pointers give each context's range, which is searched for the successor."""
        starts = decode(self.memory[slice(*self.pointers)])
        codes = self.memory[slice(*self.values)].view(np.uint16)
        context = keys >> SUCCESSOR_BITS
        begin, end = starts[context], starts[context + 1]
        out = np.zeros(len(keys), np.uint16)
        for k, (a, b) in enumerate(self.blocks):
            base = k * BLOCK
            # Keys whose range meets this block; they are neighbours, as keys and ranges are in order.
            some = slice(int(np.searchsorted(end, base, "right")), int(np.searchsorted(begin, base + BLOCK, "left")))
            if some.start >= some.stop:
                continue
            own = decode(self.memory[a:b])
            at = np.searchsorted(own, keys[some])
            inside = np.minimum(at, len(own) - 1)
            found = (own[inside] == keys[some]) & (base + at >= begin[some]) & (base + at < end[some])
            out[some] = np.where(found, codes[base + inside], out[some])
        return out
