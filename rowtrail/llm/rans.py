"""Range asymmetric numeral system over a static table of frequencies, in many interleaved lanes.

Symbol i of a block goes through lane i mod ``LANES``. A lane's state is a 64-bit number in [2^31, 2^63) and gives or takes
32-bit words. The encoder runs from the last symbol to the first, so that the decoder reads forwards: a step of the decoder takes one
symbol from each lane, then a word for each lane whose state fell below 2^31, in the order of lanes. The states before a step
together with the place in the words are a checkpoint: decoding can begin there.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 512
#: Steps from one checkpoint to the next: 2^17 symbols.
CHECKPOINT_STEPS = 256
BLOCK_SYMBOLS = LANES * CHECKPOINT_STEPS * 4
#: Fixed: how a block begins, and the version of its layout.
MAGIC = b"RTRANS01"
_HEAD = "<8sIIIIII"
_HEAD_BYTES = struct.calcsize(_HEAD)
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


class DamagedBlock(ValueError):
    """A block does not hold what its checksums say."""


class Table:
    """Frequencies that sum to 2^bits, of all symbols that occur."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray, bits: int):
        self.symbols, self.frequencies, self.bits = symbols.astype("uint32"), frequencies.astype("uint64"), bits
        self.starts = (np.cumsum(frequencies) - frequencies).astype("uint64")
        self.checksum = zlib.crc32(self.symbols.tobytes() + self.frequencies.tobytes())
        self._place = np.zeros(int(symbols.max()) + 1 if len(symbols) else 1, "int64")
        self._place[symbols] = np.arange(len(symbols))
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        """The entry that each of the 2^bits slots belongs to."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.symbols), dtype="int32"), self.frequencies.astype("int64"))
        return self._slots

    @staticmethod
    def of_counts(counts: dict[int, int]) -> Table:
        """Counts scaled to 2^bits with at least 1 for each symbol; bits leave 16 slots a symbol on average."""
        symbols = np.array(sorted(counts), "int64")
        bits = max(16, int(len(symbols)).bit_length() + 4)
        seen = np.array([counts[s] for s in symbols.tolist()], "float64")
        frequencies = np.maximum(1, np.floor(seen / max(1.0, seen.sum()) * (1 << bits))).astype("int64")
        over = int(frequencies.sum()) - (1 << bits) if len(symbols) else 0
        for place in np.argsort(-frequencies, kind="stable").tolist():
            if over <= 0:
                break
            taken = min(over, int(frequencies[place]) - 1)
            frequencies[place] -= taken
            over -= taken
        if over < 0:
            frequencies[int(np.argmax(frequencies))] -= over
        return Table(symbols, frequencies, bits)


def encode(symbols: np.ndarray, table: Table) -> bytes:
    """One block: head, checkpoints, words, and a checksum of all that."""
    n = len(symbols)
    steps = -(-n // LANES)
    places = table._place[symbols]
    frequencies, starts = table.frequencies[places], table.starts[places]
    limits = frequencies << np.uint64(63 - table.bits)
    bits = np.uint64(table.bits)
    states = np.full(LANES, _LOW, "uint64")
    chunks: list[np.ndarray] = []
    kept: list[tuple[int, bytes]] = []  # words written so far, states
    written = 0
    for step in range(steps - 1, -1, -1):
        first, last = step * LANES, min(n, (step + 1) * LANES)
        x = states[: last - first]
        full = np.nonzero(x >= limits[first:last])[0]
        if len(full):
            chunks.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x[full] >>= _WORD
            written += len(full)
        f = frequencies[first:last]
        quotient = x // f
        x[:] = (quotient << bits) + (x - quotient * f) + starts[first:last]
        if step % CHECKPOINT_STEPS == 0:
            kept.append((written, states.astype("<u8").tobytes()))
    marks = []
    for k, (words, held) in enumerate(reversed(kept)):
        part = symbols[k * CHECKPOINT_STEPS * LANES : (k + 1) * CHECKPOINT_STEPS * LANES]
        marks.append(struct.pack("<II", written - words, zlib.crc32(part.astype("<u4").tobytes())) + held)
    words = np.concatenate(chunks[::-1]).tobytes() if chunks else b""
    body = struct.pack(_HEAD, MAGIC, table.checksum, n, LANES, CHECKPOINT_STEPS, len(marks), written) + b"".join(marks) + words
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Symbols ``first`` to ``last`` (exclusive; None: all) of a block, begun at the checkpoint before them."""
    if len(block) < _HEAD_BYTES + 4 or struct.unpack("<I", block[-4:])[0] != zlib.crc32(block[:-4]):
        raise DamagedBlock("the checksum of the block differs")
    magic, checksum, n, lanes, every, marks, written = struct.unpack_from(_HEAD, block)
    if magic != MAGIC or checksum != table.checksum:
        raise DamagedBlock("the block belongs to another layout or table")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.empty(0, "uint32")
    size = 8 + 8 * lanes
    words = np.frombuffer(block, "<u4", written, _HEAD_BYTES + marks * size).astype("uint64")
    mask, bits, slots = np.uint64((1 << table.bits) - 1), np.uint64(table.bits), table.slots
    span = lanes * every
    out = np.empty(min(n, -(-last // span) * span) - first // span * span, "int32")
    offset = first // span * span
    for k in range(first // span, -(-last // span)):
        at, want = struct.unpack_from("<II", block, _HEAD_BYTES + k * size)
        states = np.frombuffer(block, "<u8", lanes, _HEAD_BYTES + k * size + 8).astype("uint64")
        end = min(n, (k + 1) * span)
        for begin in range(k * span, end, lanes):
            x = states[: min(lanes, end - begin)]
            low = x & mask
            found = slots[low.astype("int64")]
            out[begin - offset : begin - offset + len(x)] = found
            x[:] = table.frequencies[found] * (x >> bits) + low - table.starts[found]
            short = np.nonzero(x < _LOW)[0]
            if len(short):
                x[short] = (x[short] << _WORD) | words[at : at + len(short)]
                at += len(short)
        if zlib.crc32(table.symbols[out[k * span - offset : end - offset]].astype("<u4").tobytes()) != want:
            raise DamagedBlock(f"the checksum after checkpoint {k} differs")
    return table.symbols[out[first - offset : last - offset]]
