"""CRC-32C of many byte strings at once, with numpy, and the mask that record files use.

A CRC is linear over GF(2): with a zero start value, crc(a + b) = shift(crc(a), len(b)) ^ crc(b).
So a whole array of 2-byte words is looked up in one table and halved, level by level, with one
table per level that shifts by a power of two. Leading zero bytes change nothing, which
lets strings of one size class share an array; the usual start value equals inverted first bytes.
"""

from __future__ import annotations

import numpy as np

# The reflected Castagnoli polynomial, and the mask's addend.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 1 << 20
_AT_ONCE = 1 << 21


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table.astype(np.uint32)


def _shifted(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """`table` has a row for the low and one for the high half of a CRC."""
    return table[0][crc & np.uint32(0xFFFF)] ^ table[1][crc >> np.uint32(16)]


class Crc32c:
    def __init__(self) -> None:
        one = _byte_table()
        words = np.arange(1 << 16, dtype=np.uint32)
        halves = [words, words << np.uint32(16)]
        self._shift = [np.stack([(h >> np.uint32(8)) ^ one[h & np.uint32(255)] for h in halves])]
        while len(self._shift) <= BLOCK.bit_length():
            last = self._shift[-1]
            self._shift.append(np.stack([_shifted(last, _shifted(last, h)) for h in halves]))
        self._two = _shifted(self._shift[0], one[words & 255]) ^ one[words >> 8]

    def _reduced(self, rows: np.ndarray) -> np.ndarray:
        """Zero-start CRCs of equally long rows whose length is a power of two."""
        crc, level = self._two[rows.view("<u2")], 1
        while crc.shape[1] > 1:
            crc = _shifted(self._shift[level], crc[:, 0::2]) ^ crc[:, 1::2]
            level += 1
        return crc[:, 0]

    def _long(self, data: bytes) -> int:
        """Block by block; the first block takes the odd length and is at least four bytes long."""
        head = len(data) % BLOCK
        head += BLOCK if head < 4 else 0
        crc = np.array([self._inverted(data[:head])], dtype=np.uint32)
        for at in range(head, len(data), BLOCK):
            block = np.frombuffer(data, np.uint8, BLOCK, at).reshape(1, -1)
            crc = _shifted(self._shift[BLOCK.bit_length() - 1], crc) ^ self._reduced(block)
        return int(crc[0]) ^ 0xFFFFFFFF

    def _inverted(self, data: bytes) -> int:
        size = 1 << max(3, (len(data) - 1).bit_length())
        row = np.zeros((1, size), dtype=np.uint8)
        row[0, size - len(data) :] = np.frombuffer(data, np.uint8)
        row[0, size - len(data) : size - len(data) + 4] ^= 255
        return int(self._reduced(row)[0])

    def of(self, strings: list[bytes]) -> np.ndarray:
        """CRC-32C of each string; all strings have at least four bytes."""
        out = np.zeros(len(strings), dtype=np.uint32)
        classes: dict[int, list[int]] = {}
        for i, data in enumerate(strings):
            if len(data) > BLOCK:
                out[i] = self._long(data)
            else:
                classes.setdefault(max(3, (len(data) - 1).bit_length()), []).append(i)
        for bits, members in classes.items():
            size, step = 1 << bits, max(1, _AT_ONCE >> bits)
            for low in range(0, len(members), step):
                part = members[low : low + step]
                rows = np.zeros((len(part), size), dtype=np.uint8)
                for row, i in zip(rows, part):
                    data = strings[i]
                    row[size - len(data) :] = np.frombuffer(data, np.uint8)
                    row[size - len(data) : size - len(data) + 4] ^= 255
                out[part] = self._reduced(rows) ^ np.uint32(0xFFFFFFFF)
        return out

    def masked(self, strings: list[bytes]) -> np.ndarray:
        crc = self.of(strings)
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)
