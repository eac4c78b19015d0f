"""Characters as small integers, by numpy."""

from __future__ import annotations

import numpy as np

#: Symbols of the alphabet; 0 marks a word's start and end.
SYMBOLS = 64
_TABLE_SIZE = 0x3000


def _symbol(cp: int) -> int:
    lower = chr(cp).lower()[0]
    if "a" <= lower <= "z":
        return ord(lower) - 96
    if lower.isdigit():
        return 27
    if lower.isalpha():
        return 28 + ord(lower) % 24
    return 52 + cp % 11


_TABLE = np.array([0, *(_symbol(cp) for cp in range(1, _TABLE_SIZE))], dtype=np.int64)


def code_points(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each word followed by one 0, and the words' lengths with that 0."""
    text = b"\0".join(words + [b""]).decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.flatnonzero(points == 0)
    if len(ends) != len(words):  # a word that itself holds NUL characters
        points = np.concatenate([np.frombuffer((w.decode("utf-8", "replace").replace("\0", "\1") + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for w in words])
        ends = np.flatnonzero(points == 0)
    return points, np.diff(ends, prepend=-1)


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Like code_points, as symbols of the alphabet; letters of East Asian scripts share those of other letters, by their number."""
    points, lengths = code_points(words)
    wide = np.where(((points >= 0x3040) & (points < 0xD7A4)) | ((points >= 0x20000) & (points < 0x32000)), 28 + points % 24, 52 + points % 11)
    return np.where(points < _TABLE_SIZE, _TABLE[np.minimum(points, _TABLE_SIZE - 1)], wide).astype(np.int64), lengths
