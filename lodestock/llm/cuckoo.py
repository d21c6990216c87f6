"""Cuckoo filter with the keys of its slots kept beside it."""

from __future__ import annotations

from array import array

SLOTS = 4
KICKS = 200
START_BUCKETS = 64
KEY_BYTES = 32
SPREAD = 0x9E3779B1


class CuckooIndex:
    """Live digests with a value each.

    A slot has a 16-bit mark of its digest; a lookup reads two buckets, and a
    mark that matches is checked against the digest kept for that slot.  A mark
    that finds both buckets full moves another one to its other bucket; when
    that goes on too long the buckets double and all marks are placed again from
    the stored digests.  A digest has one slot at most.
    """

    def __init__(self, buckets: int = START_BUCKETS):
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets, self.live = buckets, 0
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.keys: list[bytes | None] = [None] * (SLOTS * buckets)
        self.values: list = [None] * (SLOTS * buckets)

    def _home(self, key: bytes) -> tuple[int, int]:
        """Mark (never zero) and first bucket of a digest."""
        return int.from_bytes(key[8:10], "little") or 1, int.from_bytes(key[:8], "little") & (self.buckets - 1)

    def _other(self, mark: int, bucket: int) -> int:
        return bucket ^ (mark * SPREAD & (self.buckets - 1))

    def find(self, key: bytes) -> int:
        """Slot of a live digest, or -1."""
        mark, first = self._home(key)
        for bucket in (first, self._other(mark, first)):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.marks[slot] == mark and self.keys[slot] == key:
                    return slot
        return -1

    def insert(self, key: bytes, value) -> None:
        """Add a digest that is not live."""
        while (left := self._place(key, value)) is not None:
            key, value = left
            self._grow()
        self.live += 1

    def _place(self, key: bytes, value):
        """Put a digest into a slot; the one left over, if the moves ran out."""
        mark, bucket = self._home(key)
        for kick in range(KICKS):
            for at in (bucket, self._other(mark, bucket)) if kick == 0 else (bucket,):
                for slot in range(SLOTS * at, SLOTS * at + SLOTS):
                    if not self.marks[slot]:
                        self.marks[slot], self.keys[slot], self.values[slot] = mark, key, value
                        return None
            # The victim's slot changes with the moves, so that a cycle is left.
            slot = SLOTS * bucket + (kick + mark) % SLOTS
            old = self.marks[slot], self.keys[slot], self.values[slot]
            self.marks[slot], self.keys[slot], self.values[slot] = mark, key, value
            mark, key, value = old
            bucket = self._other(mark, bucket)
        return key, value

    def _grow(self) -> None:
        """Twice the buckets, filled from the stored digests."""
        stored, buckets, live = [(k, v) for k, v in zip(self.keys, self.values) if k is not None], 2 * self.buckets, self.live
        while True:
            self._clear(buckets)
            if all(self._place(k, v) is None for k, v in stored):
                break
            buckets *= 2
        self.live = live

    def delete(self, key: bytes):
        """Value of a live digest, which leaves the index; None if there is none."""
        slot = self.find(key)
        if slot < 0:
            return None
        value, self.marks[slot], self.keys[slot], self.values[slot] = self.values[slot], 0, None, None
        self.live -= 1
        return value

    def items(self):
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)
