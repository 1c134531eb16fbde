"""Splitting a text into units that a byte-level BPE tokenizer encodes independently.

The pre-tokenizer never lets a token cross from a non-space to a white-space
character, so a text may be cut there and each cut piece ("unit": white space,
then non-space) encoded on its own and remembered: words repeat, so most of a
corpus is looked up instead of encoded again.
"""

from __future__ import annotations

import regex

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
ASCII_DOUBLE = tuple(c + " " for c in WHITE_SPACE if c < "\x80")
OTHER_DOUBLE = tuple(c + " " for c in WHITE_SPACE if c >= "\x80")
ANY_UNIT = regex.compile(r"\p{White_Space}*\P{White_Space}+|\p{White_Space}+")


def simple(text: str) -> bool:
    """Whether cutting before every single space gives whole units: no space stands
    after another white-space character or at the end."""
    if text.endswith(" ") or any(p in text for p in ASCII_DOUBLE):
        return False
    return text.isascii() or not any(p in text for p in OTHER_DOUBLE)


def units(text: str) -> list[str]:
    """Units of ``text`` in order; joined they give the text."""
    if simple(text):
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + p for p in rest]
    return ANY_UNIT.findall(text)


class UnitMemo:
    """``text -> [value of each unit]`` with ``encode(list of units) -> list of values``,
    called once per batch for the units not met before.

    Words after a space are kept without it, so a simple text is split and looked up
    with no other string made. Bounded: emptied when it holds more than ``limit`` units; units longer than
    ``longest`` code points are never kept.
    """

    def __init__(self, encode, limit: int = 1_200_000, longest: int = 64):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def values(self, texts: list[str]) -> list[list[bytes]]:
        if len(self.known) + len(self.spaced) > self.limit:
            self.known.clear()
            self.spaced.clear()
        spaced, known = self.spaced, self.known
        out, again, missing = [], [], set()
        for i, text in enumerate(texts):
            if simple(text):
                first, *rest = text.split(" ")
                got = list(map(spaced.get, rest))
                lead = [known.get(first)] if first else []
                if None in got or None in lead:
                    missing.update([" " + w for w, g in zip(rest, got) if g is None])
                    if None in lead:
                        missing.add(first)
                    again.append((i, first, rest))
                out.append(lead + got if lead else got)
            else:
                split = ANY_UNIT.findall(text)
                got = [spaced.get(u[1:]) if u[0] == " " else known.get(u) for u in split]
                if None in got:
                    missing.update([u for u, g in zip(split, got) if g is None])
                    again.append((i, None, split))
                out.append(got)
        if missing:
            missing = list(missing)
            once = {}
            for u, v in zip(missing, self.encode(missing)):
                if len(u) > self.longest:
                    once[u] = v
                elif u[0] == " ":
                    spaced[u[1:]] = v
                else:
                    known[u] = v
            for i, first, split in again:
                if first is None:
                    out[i] = [(spaced.get(u[1:]) if u[0] == " " else known.get(u)) or once[u] for u in split]
                    continue
                got = list(map(spaced.get, split))
                if None in got:
                    got = [once[" " + w] if g is None else g for w, g in zip(split, got)]
                if first:
                    lead = known.get(first)
                    got.insert(0, once[first] if lead is None else lead)
                out[i] = got
        return out
