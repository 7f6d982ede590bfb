"""Static range asymmetric numeral systems over token ids, with numpy.

A table gives each id a share of 2**20 slots; it is shared by the blocks of a segment. A block is coded by `lanes` interleaved states: ids
j, j + lanes, j + 2 * lanes, ... belong to state j, and all states take one step at a time. States are 64-bit and give off 32-bit
words. A checkpoint holds the states and the place in the words before a step, so that decoding can begin at each of them
independently. Words and states carry a CRC-32.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
LOW = np.uint64(1 << 31)
_U = np.uint64


@dataclass(frozen=True)
class Table:
    """ids in ascending order and the slots of each, which add up to SLOTS."""

    ids: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, tokens: np.ndarray) -> Table:
        counts = np.bincount(tokens)
        ids = np.flatnonzero(counts)
        if len(ids) > SLOTS // 2:
            raise ValueError("too many different ids for one table")
        counts = counts[ids]
        slots = np.maximum(1, counts * SLOTS // max(1, counts.sum()))
        # What rounding took or gave goes to the most frequent ids.
        order = np.argsort(-slots, kind="stable")
        rest = SLOTS - int(slots.sum())
        for i in order.tolist():
            change = rest if rest > 0 else max(rest, 1 - int(slots[i]))
            slots[i] += change
            rest -= change
            if rest == 0:
                break
        return cls(ids, slots)


@dataclass(frozen=True)
class Block:
    n: int
    lanes: int
    every: int  # steps between checkpoints
    states: np.ndarray  # a row of lanes for each checkpoint
    places: np.ndarray  # its place in the words
    words: np.ndarray
    crc32: int

    def checksum(self) -> int:
        return zlib.crc32(self.words.tobytes(), zlib.crc32(self.places.tobytes(), zlib.crc32(self.states.tobytes())))


class Coder:
    def __init__(self, table: Table) -> None:
        self.table = table
        size = int(table.ids.max(initial=0)) + 1
        self.share, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.share[table.ids] = table.slots
        begin = np.cumsum(table.slots) - table.slots
        self.start[table.ids] = begin
        self.id_of = np.repeat(table.ids, table.slots).astype(np.uint32)
        self.share_of = np.repeat(table.slots, table.slots).astype(np.uint64)
        self.within = (np.arange(len(self.id_of)) - np.repeat(begin, table.slots)).astype(np.uint64)

    def encode(self, tokens: np.ndarray, lanes: int = 1024, every: int = 64) -> Block:
        steps = -(-len(tokens) // lanes)
        share, start = self.share[tokens], self.start[tokens]
        limit = share << _U(43)
        x = np.full(lanes, LOW)
        words: list[np.ndarray] = [np.zeros(0, np.uint32)] * steps
        states = np.zeros((-(-steps // every), lanes), np.uint64)
        for t in range(steps - 1, -1, -1):
            part = slice(t * lanes, min((t + 1) * lanes, len(tokens)))
            f = share[part]
            live = x[: len(f)]
            full = live >= limit[part]
            out = live[full]
            words[t] = out.astype(np.uint32)  # the low half
            live[full] = out >> _U(32)
            whole = live // f
            x[: len(f)] = (whole << _U(SLOT_BITS)) + (live - whole * f) + start[part]
            if t % every == 0:
                states[t // every] = x
        sizes = np.fromiter(map(len, words), np.int64, steps)
        places = (np.cumsum(sizes) - sizes)[::every].astype(np.int64)
        block = Block(len(tokens), lanes, every, states, places, np.concatenate([np.zeros(0, np.uint32), *words]), 0)
        return Block(**{**block.__dict__, "crc32": block.checksum()})

    def decode(self, block: Block, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids between two checkpoints (`last` excluded), by default all."""
        if block.checksum() != block.crc32:
            raise ValueError("a block of token ids is damaged")
        last = len(block.places) if last is None else last
        begin, end = first * block.every, min(last * block.every, -(-block.n // block.lanes))
        out = np.zeros((max(0, end - begin), block.lanes), np.uint32)
        if end > begin:
            x, place = block.states[first].copy(), int(block.places[first])
        for t in range(begin, end):
            width = min(block.lanes, block.n - t * block.lanes)
            live = x[:width]
            slot = (live & _U(SLOTS - 1)).astype(np.int64)
            out[t - begin, :width] = self.id_of[slot]
            live = self.share_of[slot] * (live >> _U(SLOT_BITS)) + self.within[slot]
            low = np.flatnonzero(live < LOW)
            live[low] = (live[low] << _U(32)) | block.words[place : place + len(low)].astype(np.uint64)
            place += len(low)
            x[:width] = live
        return out.ravel()[: min(block.n, end * block.lanes) - begin * block.lanes]
