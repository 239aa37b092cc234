"""A range asymmetric numeral system over static frequencies, in numpy lanes.

A block of symbols is dealt to lanes in turn: symbol i belongs to lane i mod the number of lanes. Every lane has
a state of its own; all lanes push 32-bit words onto one stack of words, which is what interleaves them. Coding
runs from the last symbol to the first, so decoding reads words forwards. States at a checkpoint and the place in
the words are all that decoding from there needs, so the parts between checkpoints decode independently.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LOW = np.uint64(1 << 31)  # a state is in [LOW, LOW << 32)
WORD = np.uint64(32)
TABLE_MAGIC = b"RTB1"


@dataclass(frozen=True)
class Table:
    """Symbols in ascending order and their frequencies, which add up to ``1 << bits``."""

    bits: int
    symbols: np.ndarray
    freqs: np.ndarray

    def __post_init__(self):
        starts = np.cumsum(self.freqs) - self.freqs
        place = np.zeros(int(self.symbols.max(initial=0)) + 1, dtype=np.int64)
        place[self.symbols] = np.arange(len(self.symbols))
        for name, value in (
            ("place", place),
            ("wide", self.freqs.astype(np.uint64)),
            ("starts", starts.astype(np.uint64)),
            ("slots", np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freqs)),
        ):
            object.__setattr__(self, name, value)

    def to_bytes(self) -> bytes:
        body = zlib.compress(self.symbols.astype("<u4").tobytes() + self.freqs.astype("<u4").tobytes())
        head = TABLE_MAGIC + struct.pack("<BI", self.bits, len(self.symbols))
        return head + body + struct.pack("<I", zlib.crc32(head + body))

    @staticmethod
    def from_bytes(data: bytes) -> Table:
        if data[:4] != TABLE_MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged frequency table")
        bits, n = struct.unpack("<BI", data[4:9])
        numbers = np.frombuffer(zlib.decompress(data[9:-4]), dtype="<u4").astype(np.int64)
        return Table(bits, numbers[:n], numbers[n:])


def table_of(symbols: np.ndarray, counts: np.ndarray, bits: int) -> Table:
    """Frequencies in proportion to counts, at least 1 each; more bits than asked if there are too many symbols."""
    order = np.argsort(symbols)
    symbols, counts = np.asarray(symbols, dtype=np.int64)[order], np.asarray(counts, dtype=np.float64)[order]
    if not len(symbols):
        return Table(bits, symbols, np.zeros(0, dtype=np.int64))
    bits = max(bits, (4 * len(symbols)).bit_length())
    total = 1 << bits
    freqs = np.maximum(1, np.floor(counts * (total / counts.sum())).astype(np.int64))
    over = int(freqs.sum()) - total
    if over < 0:
        freqs[np.argmax(freqs)] -= over
    for i in np.argsort(-freqs, kind="stable"):  # what the floor of 1 took comes from the largest
        if over <= 0:
            break
        taken = min(over, int(freqs[i]) // 2)
        freqs[i] -= taken
        over -= taken
    return Table(bits, symbols, freqs)


def encode(ids: np.ndarray, table: Table, lanes: int, every: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """(words, checkpoints); a checkpoint stands every ``every`` steps and holds (place in words, states)."""
    where = table.place[ids]
    n, steps = len(ids), -(-len(ids) // lanes)
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, LOW, dtype=np.uint64)
    pushed: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    total = 0
    for step in range(steps - 1, -1, -1):
        at = where[step * lanes : min(n, (step + 1) * lanes)]
        f, x = table.wide[at], state[: len(at)]
        full = x >= (f << room)
        if full.any():
            out = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            pushed.append(out)
            total += len(out)
            x = np.where(full, x >> WORD, x)
        q = x // f
        state[: len(at)] = (q << bits) + (x - q * f) + table.starts[at]
        if step % every == 0:
            marks.append((total, state.copy()))
    words = np.concatenate(pushed[::-1]) if pushed else np.zeros(0, dtype="<u4")
    return words, [(total - place, states) for place, states in reversed(marks)]


def decode(words: np.ndarray, states: np.ndarray, n: int, table: Table) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, states behind them, words read) of the ``n`` symbols that follow a checkpoint."""
    lanes = len(states)
    state = states.astype(np.uint64)
    out = np.empty(n, dtype=np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    symbols = table.symbols.astype(np.uint32)
    at = 0
    for first in range(0, n, lanes):
        size = min(lanes, n - first)
        x = state[:size]
        low = x & mask
        found = table.slots[low]
        x = table.wide[found] * (x >> bits) + low - table.starts[found]
        short = np.flatnonzero(x < LOW)
        if len(short):
            x[short] = (x[short] << WORD) | words[at : at + len(short)].astype(np.uint64)
            at += len(short)
        state[:size] = x
        out[first : first + size] = symbols[found]
    return out, state, at


def decode_all(words: np.ndarray, marks: list[tuple[int, np.ndarray]], n: int, span: int, table: Table) -> Iterator[np.ndarray]:
    """The ids of each part between checkpoints; a part must end in the states of the next checkpoint."""
    for i, (place, states) in enumerate(marks):
        size = min(span, n - i * span)
        ids, end, used = decode(words[place:], states, size, table)
        after = marks[i + 1][1] if i + 1 < len(marks) else np.full(len(states), LOW, dtype=np.uint64)
        if not np.array_equal(end, after) or place + used != (marks[i + 1][0] if i + 1 < len(marks) else len(words)):
            raise ValueError("a part does not end at the next checkpoint")
        yield ids
