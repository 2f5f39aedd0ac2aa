"""Loops in generated text, as plain functions for Arrow batches."""

from __future__ import annotations

import math
import re
from collections import Counter

_TOKEN = re.compile(r"\w+|[^\w\s]")
#: Fixed values of the tail rule: longest period, least repeats and characters, least share, characters that may follow.
PERIODS, REPEATS, CHARS, SHARE, TRAILERS = 200, 5, 100, 0.35, (0, 8, 24, 64, 160, 400)


def has_ngram_loop(text: str) -> bool:
    """One token is most of a text, or one phrase of two to five tokens over a third of it."""
    tokens = _TOKEN.findall(text.lower())
    n = len(tokens)
    if n < 6:
        return False
    top = Counter(tokens).most_common(1)[0][1]
    if top >= 6 and top >= 0.75 * n:
        return True
    if n < 24:
        return False
    for k in range(2, 6):
        if n >= 8 * k:
            best = max(Counter(zip(*(tokens[i:] for i in range(k)))).values())
            if best >= 12 and best * k >= 0.35 * n:
                return True
    return False


def has_tail_loop(text: str) -> bool:
    """A unit of up to 200 characters repeats through the last third of a text, save for a short trailer.

    The stretch that must repeat is compared with itself one period on; a cheap look at a few of its characters goes first.
    """
    n = len(text)
    floor = math.ceil(SHARE * n)
    for trailer in TRAILERS:
        end = n - trailer
        if end < CHARS:
            return False
        last = text[end - 1]
        for period in range(1, PERIODS + 1):
            need = max(CHARS, REPEATS * period, floor)
            if need > end:
                break
            if text[end - 1 - period] == last and text.startswith(text[end - need : end - period], end - need + period):
                return True
    return False


def trailing_repeats(text: str, longest: int = 10) -> list[int]:
    """How often the last 1, 2, ... characters stand back to back at the end, white space collapsed."""
    s = re.sub(r"\s+", " ", text)
    out = [0] * longest
    for size in range(1, min(longest, len(s)) + 1):
        unit, at = s[-size:], len(s)
        while at >= size and s[at - size : at] == unit:
            out[size - 1] += 1
            at -= size
    return out
