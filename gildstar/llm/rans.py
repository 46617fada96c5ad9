"""Static range asymmetric numeral system over token ids, vectorised over blocks and lanes.

A frame holds blocks that share one frequency table.  Token ``i`` of a block
belongs to lane ``i mod LANES``; every lane has its own 63-bit state and all
lanes of a block write 32-bit words into one interleaved stream.  Blocks are
independent of each other.  Every ``CHECKPOINT_STEPS`` steps a checkpoint keeps
the lane states and the place in the stream, so decoding can start there; the
decoder below starts at all of them at once.  A crc32 of its ids guards each
block.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

LANES = 32
CHECKPOINT_STEPS = 1024
_LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63)
_WORD = np.uint64(32)
_TABLED = 1 << 20  # ids below are counted and looked up in tables of this size at most


@dataclass
class Frame:
    """An encoded frame; ``blocks`` has (n ids, n words, crc32) per block."""

    table: bytes
    blocks: list[tuple[int, int, int]]
    states: bytes
    checkpoints: bytes
    payload: bytes


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def build_table(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits, symbols, frequencies): frequencies are at least 1 and add up to 2^bits."""
    if len(ids) and int(ids.max()) < _TABLED:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
    else:
        symbols, counts = np.unique(ids, return_counts=True)
    bits = min(28, max(12, int(len(symbols)).bit_length() + 3))
    free = (1 << bits) - len(symbols)
    freq = 1 + (counts.astype(object) * free // int(counts.sum())).astype(np.int64)
    freq[np.argmax(freq)] += (1 << bits) - int(freq.sum())
    return bits, symbols.astype(np.uint32), freq


def pack_table(bits: int, symbols: np.ndarray, freq: np.ndarray) -> bytes:
    gaps = np.diff(symbols.astype(np.int64), prepend=0).astype("<u4")
    return struct.pack("<BI", bits, len(symbols)) + zlib.compress(gaps.tobytes() + freq.astype("<u4").tobytes())


def unpack_table(data: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    bits, n = struct.unpack_from("<BI", data)
    both = np.frombuffer(zlib.decompress(data[5:]), "<u4")
    return bits, np.cumsum(both[:n].astype(np.int64)).astype(np.uint32), both[n:].astype(np.int64)


def _places(symbols: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where each id stands in the sorted ``symbols``."""
    if int(symbols[-1]) >= _TABLED:
        return np.searchsorted(symbols, ids.astype(np.uint32))
    place = np.zeros(int(symbols[-1]) + 1, np.int32)
    place[symbols] = np.arange(len(symbols))
    return place[ids]


def _active(steps: np.ndarray) -> np.ndarray:
    """For steps sorted downwards: how many rows are still active at each step."""
    return len(steps) - np.searchsorted(steps[::-1], np.arange(int(steps[0]) if len(steps) else 0), side="right")


def encode(ids: np.ndarray, lengths: list[int]) -> Frame:
    """Encode ``ids``, cut into blocks of the given lengths (each at least 1)."""
    bits, symbols, freq = build_table(ids)
    start = np.cumsum(freq) - freq
    local = _places(symbols, ids)
    n = np.array(lengths, np.int64)
    first = np.cumsum(n) - n
    steps = -(-n // LANES)
    order = np.argsort(-steps, kind="stable")
    most = int(steps.max())
    # Rows by falling length; the last step of a block is filled up with the likeliest symbol.
    grid = np.full((len(n), most * LANES), int(np.argmax(freq)), np.int32)
    for row, block in enumerate(order):
        grid[row, : n[block]] = local[first[block] : first[block] + n[block]]
    grid = grid.reshape(len(n), most, LANES)
    f64, c64, m = freq.astype(np.uint64), start.astype(np.uint64), np.uint64(bits)
    ceiling = f64 << np.uint64(63 - bits)
    x = np.full((len(n), LANES), _LOW, np.uint64)
    words = np.empty((len(n), most * LANES), np.uint32)
    row_start, flat_words = np.arange(len(n))[:, None] * (most * LANES) - 1, words.reshape(-1)
    at = np.full(len(n), most * LANES, np.int64)
    active = _active(steps[order])
    marks: list[tuple[int, np.ndarray, np.ndarray]] = []
    for t in range(most - 1, -1, -1):
        k = int(active[t])
        s = grid[:k, t]
        f, state = f64[s], x[:k]
        full = state >= ceiling[s]
        if full.any():
            at[:k] -= full.sum(1)
            place = row_start[:k] + at[:k, None] + np.cumsum(full, 1)
            flat_words[place[full]] = state[full].astype(np.uint32)  # the lower half
            state = np.where(full, state >> _WORD, state)
        q = state // f
        x[:k] = (q << m) + (state - q * f) + c64[s]
        if t and t % CHECKPOINT_STEPS == 0:
            marks.append((t, x[:k].copy(), at[:k].copy()))
    back = np.argsort(order)
    n_words = most * LANES - at
    checkpoints = b"".join(
        struct.pack("<III", int(order[row]), t, int(place[row] - at[row])) + states[row].astype("<u8").tobytes()
        for t, states, place in marks
        for row in range(len(states))
    )
    return Frame(
        pack_table(bits, symbols, freq),
        [
            (int(n[b]), int(n_words[back[b]]), crc_of(ids[first[b] : first[b] + n[b]]))
            for b in range(len(n))
        ],
        x[back].astype("<u8").tobytes(),
        checkpoints,
        b"".join(words[back[b], at[back[b]] :].astype("<u4").tobytes() for b in range(len(n))),
    )


def decode(frame: Frame) -> np.ndarray:
    """The ids of all blocks in order; raises ValueError if a block's checksum differs."""
    bits, symbols, freq = unpack_table(frame.table)
    start = np.cumsum(freq) - freq
    of_slot = np.repeat(np.arange(len(symbols), dtype=np.int32), freq)
    n = np.array([b[0] for b in frame.blocks], np.int64)
    n_words = np.array([b[1] for b in frame.blocks], np.int64)
    base = np.cumsum(n_words) - n_words
    steps = -(-n // LANES)
    states = np.frombuffer(frame.states, "<u8").reshape(len(n), LANES)
    # One run per block start and per checkpoint: (block, first step, place in the payload, states).
    runs = [(b, 0, int(base[b]), states[b]) for b in range(len(n))]
    size = 12 + 8 * LANES
    for i in range(0, len(frame.checkpoints), size):
        block, t, place = struct.unpack_from("<III", frame.checkpoints, i)
        runs.append((block, t, int(base[block]) + place, np.frombuffer(frame.checkpoints, "<u8", LANES, i + 12)))
    todo = np.array([min(CHECKPOINT_STEPS, int(steps[b]) - t) for b, t, _, _ in runs], np.int64)
    order = np.argsort(-todo, kind="stable")
    x = np.stack([runs[i][3] for i in order]).astype(np.uint64)
    at = np.array([runs[i][2] for i in order], np.int64)
    payload = np.frombuffer(frame.payload, "<u4").astype(np.uint64)
    if not len(payload):
        payload = np.zeros(1, np.uint64)
    f64, c64, m, mask = freq.astype(np.uint64), start.astype(np.uint64), np.uint64(bits), np.uint64((1 << bits) - 1)
    active = _active(todo[order])
    out = np.zeros((len(runs), len(active), LANES), np.int32)
    for t in range(len(active)):
        k = int(active[t])
        state = x[:k]
        slot = state & mask
        s = of_slot[slot]
        out[:k, t] = s
        state = f64[s] * (state >> m) + slot - c64[s]
        low = state < _LOW
        if low.any():
            place = at[:k, None] + np.cumsum(low, 1) - 1
            word = payload.take(place, mode="clip")
            state = np.where(low, (state << _WORD) | word, state)
            at[:k] += low.sum(1)
        x[:k] = state
    ids = np.empty(int(n.sum()), np.uint32)
    first = np.cumsum(n) - n
    for row, i in enumerate(order.tolist()):
        block, t, _, _ = runs[i]
        a = t * LANES
        b = min(int(n[block]), a + int(todo[i]) * LANES)
        ids[first[block] + a : first[block] + b] = symbols[out[row].reshape(-1)[: b - a]]
    for b, (length, _, crc) in enumerate(frame.blocks):
        if crc_of(ids[first[b] : first[b] + length]) != crc:
            raise ValueError(f"block {b}: checksum differs")
    return ids
