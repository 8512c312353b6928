"""Small sets of numbers as hexadecimal bitmaps, kept with a table version."""

from __future__ import annotations

from collections.abc import Iterable


def to_bitmap(numbers: Iterable[int], size: int) -> str:
    bits = bytearray(-(-size // 8))
    for n in numbers:
        bits[n >> 3] |= 1 << (n & 7)
    return bits.hex()


def members(bitmap: str) -> list[int]:
    return [8 * i + k for i, byte in enumerate(bytes.fromhex(bitmap)) if byte for k in range(8) if byte >> k & 1]


def overlap(a: str, b: str) -> bool:
    return bool(int(a, 16) & int(b, 16))
