"""Counting quotient filter over 64-bit fingerprints, vectorised with numpy.

A fingerprint splits into a quotient (its high ``q`` bits, the home slot) and a
remainder (the rest).  Remainders of one quotient stand in one sorted run; the
``occupied`` bits say which quotients have a run and the ``run_end`` bits where
each run ends, so every fingerprint can be read back and filters of different
partitions merge without loss.  ``counts`` holds the multiplicity of each slot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class CountingQuotientFilter:
    """One filter, or the part of one that covers a block of quotients."""

    quotient_bits: int
    occupied: np.ndarray  # bool, one for each quotient
    run_end: np.ndarray  # bool, one for each used slot in slot order
    remainders: np.ndarray  # uint64, sorted within each run
    counts: np.ndarray  # int64

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, counts: np.ndarray, width: int = 64):
        """From distinct ascending fingerprints of ``width`` bits, with a quotient for each."""
        quotient_bits = max(1, len(fingerprints) - 1).bit_length()
        low = np.uint64(width - quotient_bits)
        quotients = (fingerprints >> low).astype(np.int64)
        occupied = np.zeros(1 << quotient_bits, dtype=bool)
        occupied[quotients] = True
        run_end = np.ones(len(fingerprints), dtype=bool)
        run_end[:-1] = quotients[1:] != quotients[:-1]
        return cls(quotient_bits, occupied, run_end, fingerprints & ((np.uint64(1) << low) - np.uint64(1)), counts)

    def fingerprints(self, width: int = 64) -> np.ndarray:
        """All fingerprints, ascending: the k-th run belongs to the k-th occupied quotient."""
        run = np.cumsum(self.run_end) - self.run_end
        quotients = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotients << np.uint64(width - self.quotient_bits)) | self.remainders

    def pack(self) -> tuple[bytes, bytes, bytes, bytes]:
        return (
            np.packbits(self.occupied).tobytes(),
            np.packbits(self.run_end).tobytes(),
            self.remainders.astype("<u8").tobytes(),
            self.counts.astype("<i8").tobytes(),
        )

    @classmethod
    def unpack(cls, quotient_bits: int, occupied: bytes, run_end: bytes, remainders: bytes, counts: bytes):
        left = np.frombuffer(remainders, "<u8")
        bits = lambda b, n: np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
        return cls(
            quotient_bits, bits(occupied, 1 << quotient_bits), bits(run_end, len(left)), left, np.frombuffer(counts, "<i8")
        )

    @classmethod
    def merge(cls, parts: list["CountingQuotientFilter"], width: int = 64) -> "CountingQuotientFilter":
        """Merge runs by their sorted remainders; counts of equal fingerprints add up."""
        together = np.concatenate([p.fingerprints(width) for p in parts])
        counts = np.concatenate([p.counts for p in parts])
        order = np.argsort(together, kind="stable")
        together, counts = together[order], counts[order]
        first = np.ones(len(together), dtype=bool)
        first[1:] = together[1:] != together[:-1]
        starts = np.flatnonzero(first)
        sums = np.add.reduceat(counts, starts) if len(starts) else counts
        return cls.of_sorted(together[starts], sums, width)
