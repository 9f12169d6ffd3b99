"""Splitting text the way the byte-level tokenizer does, with ``re`` alone.

The character classes are derived from Unicode categories, so the split equals
the tokenizer's pattern `` ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+`` with its
contractions, at a fraction of the cost of a general Unicode regex engine.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache


def _ranges(codes: list[int]) -> str:
    out, k = [], 0
    while k < len(codes):
        j = k
        while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
            j += 1
        out.append(f"\\U{codes[k]:08x}-\\U{codes[j]:08x}")
        k = j + 1
    return "".join(out)


#: Unicode White_Space (fixed values)
SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _later_characters() -> dict[int, str]:
    """Letters and numbers that the tokenizer's Unicode version has and Python's
    has not: the newest version's candidates, each tried with the tokenizer."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel
    free = "".join(chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    out = {}
    for ch in "".join(regex.findall(r"[\p{L}\p{N}]+", free)):
        if len(split("a" + ch)) == 1:
            out[ord(ch)] = "L"
        elif len(split("1" + ch)) == 1:
            out[ord(ch)] = "N"
    return out


@lru_cache(None)
def _classes() -> dict[str, list[int]]:
    by = {"L": [], "N": []}
    late = _later_characters()
    for c in range(sys.maxunicode + 1):
        kind = late.get(c) or unicodedata.category(chr(c))[0]
        if kind in by:
            by[kind].append(c)
    return by | {"S": SPACE}


@lru_cache(None)
def _pattern(last: int) -> re.Pattern:
    """For texts whose code points are at most ``last``: small classes are faster."""
    letters, numbers, space = (_ranges([c for c in _classes()[k] if c <= last]) for k in "LNS")
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+"
                      f"| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")


_WIDE = re.compile("[\U00010000-\U0010ffff]")


def split(text: str) -> list[str]:
    """The pieces of a text, in order; joined they are the text."""
    try:
        text.encode("latin-1")
        last = 0xFF
    except UnicodeEncodeError:
        last = sys.maxunicode if _WIDE.search(text) else 0xFFFF
    return _pattern(last).findall(text)


_ODD_SPACE = re.compile(f" (?=[{_ranges(SPACE)}])| \\Z")


def chunks(text: str) -> list[str] | None:
    """The text cut at its spaces, which are left out; None if a space stands before
    white space or at the end.  Otherwise each chunk but the first, with a space before
    it, splits into pieces by itself: a space belongs to what follows it."""
    return None if _ODD_SPACE.search(text) else text.split(" ")


class PieceCache(dict):
    """piece -> value, made on first use.  Emptied when ``limit`` pieces are held,
    so a worker's memory stays bounded; long pieces are not held at all."""

    def __init__(self, make, limit: int = 500_000, longest: int = 100) -> None:
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, piece):
        value = self.make(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = value
        return value
