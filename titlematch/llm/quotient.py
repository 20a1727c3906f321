"""A counting quotient filter over 64-bit fingerprints, as numpy arrays.

A fingerprint splits into block (top bits), quotient (next bits) and remainder
(the rest).  A filter holds one block: ``occupied`` marks quotients that occur,
``run_end`` the last slot of each quotient's run, ``remainders`` the sorted
remainders, and counters stand beside the slots that were added more than once.
No bits of a fingerprint are lost, so filters of one block merge losslessly by
going through their sorted remainders and adding the counts.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

_HEAD = struct.Struct("<BBIII")


class QuotientFilter:
    def __init__(self, quotient_bits: int, remainder_bits: int, keys: np.ndarray, counts: np.ndarray):
        """``keys``: sorted distinct ``quotient_bits + remainder_bits``-bit values."""
        self.quotient_bits, self.remainder_bits, self.keys, self.counts = quotient_bits, remainder_bits, keys, counts

    @classmethod
    def build(cls, quotient_bits: int, remainder_bits: int, keys: np.ndarray) -> QuotientFilter:
        return cls(quotient_bits, remainder_bits, *np.unique(keys, return_counts=True))

    def to_bytes(self) -> bytes:
        r, width = self.remainder_bits, -(-self.remainder_bits // 8)
        quotients = (self.keys >> np.uint64(r)).astype(np.int64)
        occupied = np.zeros(1 << self.quotient_bits, dtype=bool)
        occupied[quotients] = True
        run_end = np.append(quotients[1:] != quotients[:-1], True)[: len(quotients)]
        remainders = (self.keys & np.uint64((1 << r) - 1)).astype("<u8")
        slots = remainders.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
        many = np.flatnonzero(self.counts > 1)
        # sparse blocks list their occupied quotients instead of the bitmap
        listed = np.flatnonzero(occupied).astype("<u4")
        sparse = listed.nbytes < (1 << self.quotient_bits) // 8
        marks = listed.tobytes() if sparse else np.packbits(occupied).tobytes()
        head = _HEAD.pack(self.quotient_bits, r, len(self.keys), len(many), len(listed) if sparse else 0xFFFFFFFF)
        return b"".join(
            (head, marks, np.packbits(run_end).tobytes(), slots, many.astype("<u4").tobytes(), self.counts[many].astype("<u8").tobytes())
        )

    @classmethod
    def from_bytes(cls, blob: bytes) -> QuotientFilter:
        q, r, n, many, listed = _HEAD.unpack_from(blob)
        at, width = _HEAD.size, -(-r // 8)
        if listed != 0xFFFFFFFF:
            quotients = np.frombuffer(blob, "<u4", listed, at).astype(np.uint64)
            at += 4 * listed
        else:
            size = (1 << q) // 8
            quotients = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, at))).astype(np.uint64)
            at += size
        size = -(-n // 8)
        run_end = np.unpackbits(np.frombuffer(blob, np.uint8, size, at))[:n]
        at += size
        slots = np.zeros((n, 8), dtype=np.uint8)
        slots[:, :width] = np.frombuffer(blob, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        run = np.cumsum(run_end) - run_end  # which run each slot belongs to
        keys = (quotients[run] << np.uint64(r)) | slots.reshape(-1).view("<u8")
        counts = np.ones(n, dtype=np.int64)
        counts[np.frombuffer(blob, "<u4", many, at)] = np.frombuffer(blob, "<u8", many, at + 4 * many).astype(np.int64)
        return cls(q, r, keys, counts)

    @classmethod
    def merge(cls, filters: Iterable[QuotientFilter]) -> QuotientFilter:
        filters = list(filters)
        keys = np.concatenate([f.keys for f in filters])
        order = np.argsort(keys, kind="stable")  # merges the sorted runs
        keys, counts = keys[order], np.concatenate([f.counts for f in filters])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        return cls(filters[0].quotient_bits, filters[0].remainder_bits, keys[first], np.add.reduceat(counts, first) if len(first) else counts)
