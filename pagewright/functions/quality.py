"""The deterministic quality gate: one verdict a text, from column expressions and one Arrow function for loops."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .loops import has_ngram_loop, has_tail_loop
from .text import SPACE, strip

#: The checks in the order in which they are made, and what switches all off.
CHECKS = ("empty_output", "mojibake", "control_characters", "refusal_boilerplate", "malformed_frontmatter", "repeated_character", "repeated_ngram", "repeated_tail", "truncation_indicator", "length_anomaly")
ALL = "all"
#: Phrases of a refusal, anywhere in a text; polite ones, that count in a short text only.
REFUSALS = r"\bas an ai\b|\bi am unable to help\b|\bi can'?t help\b|\bi cannot help\b|\bi cannot provide\b|\bi cannot comply\b"
POLITE = r"\bi'?m sorry\b|\bsorry,? but\b"
POLITE_LENGTH = 600
#: Least and greatest length, a run's length, characters that may run, share and number of lost characters.
SHORTEST, LONGEST = 5, 50_000
RUN, FILL = 24, r"_.\-–—·•*=~"
LOST_SHARE, LOST_COUNT = 0.02, 3
#: Rejections that a blank page explains.
BLANK_KINDS = ("empty_output", "repeated_ngram", "repeated_character", "repeated_tail")
BLANK_INK = 0.01
_BREAKS = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{0085}\x{2028}\x{2029}]"


def expand_disabled(names: Iterable[str]) -> frozenset[str]:
    names = frozenset(names)
    return frozenset(CHECKS) if ALL in names else names


@F.pandas_udf(T.BooleanType())
def _ngram_loop(text: pd.Series) -> pd.Series:
    return text.map(has_ngram_loop, na_action="ignore")


@F.pandas_udf(T.BooleanType())
def _tail_loop(text: pd.Series) -> pd.Series:
    return text.map(has_tail_loop, na_action="ignore")


def malformed_preamble(text: Column) -> Column:
    """A text that begins with ``---`` without an end of the preamble, or with unequal brackets in a line of it."""
    lines = F.split(text, _BREAKS)
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    end = F.array_position(F.transform(rest, strip), F.lit("---"))
    count = lambda x, c: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))
    uneven = F.exists(F.slice(rest, F.lit(1), F.greatest((end - 1).cast("int"), F.lit(0))), lambda x: (count(x, "[") != count(x, "]")) | (count(x, "{") != count(x, "}")))
    return text.startswith("---") & ((end == 0) | uneven)


def checks(text: Column) -> dict[str, Column]:
    """Each check's condition on a stripped text that is not empty."""
    low, n = F.lower(text), F.length(text)
    lost = n - F.length(F.replace(text, F.lit("�"), F.lit("")))
    return {
        "mojibake": (lost >= LOST_COUNT) | (lost.cast("double") / F.greatest(n, F.lit(1)) > LOST_SHARE),
        "control_characters": text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"),
        "refusal_boilerplate": low.rlike(REFUSALS) | ((n <= POLITE_LENGTH) & low.rlike(POLITE)),
        "malformed_frontmatter": malformed_preamble(text),
        "repeated_character": text.rlike(rf"(?s)([^{SPACE}{FILL}])\1{{{RUN - 1},}}"),
        "repeated_ngram": _ngram_loop(text),
        "repeated_tail": _tail_loop(text),
        "truncation_indicator": low.rlike(r"\.\.\.$") | low.rlike(r"\[\.\.\.\]$") | low.contains("truncated"),
        "length_anomaly": (n < SHORTEST) | (n > LONGEST),
    }


def assess(text: Column, disabled: Iterable[str] = ()) -> Column:
    """The codes of all failed checks in their order; empty if the text is accepted. A null text counts as empty.

    An empty text fails the empty check alone, or is accepted where that is off.
    """
    off = expand_disabled(disabled)
    t = strip(F.coalesce(text, F.lit("")))
    found = [F.when(c, F.lit(k)) for k, c in checks(t).items() if k not in off]
    rest = F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")
    return F.when(t == "", F.array() if "empty_output" in off else F.array(F.lit("empty_output"))).otherwise(rest).cast("array<string>")


def verdict(stripped: Column, disabled: Iterable[str] = ()) -> Column:
    """The first failed check's public name, or 'ok', of a text without white space around it: what ``kind(assess(text))`` gives, but
    later checks are not made once one has failed. Give it a column of its own, not an expression."""
    off = expand_disabled(disabled)
    out = F.when(stripped == "", "ok" if "empty_output" in off else "empty_output")
    for k, c in checks(stripped).items():
        if k not in off:
            out = out.when(c, "refusal" if k == "refusal_boilerplate" else k)
    return out.otherwise("ok")


def kind(issues: Column) -> Column:
    """The first issue by its public name; 'ok' without any."""
    first = F.when(F.size(issues) > 0, F.get(issues, F.lit(0))).otherwise(F.lit("ok"))
    return F.when(first == "refusal_boilerplate", F.lit("refusal")).otherwise(first)


def retry_class(kind_: Column) -> Column:
    return F.when(kind_ == "ok", "none").when(kind_ == "refusal", "terminal").otherwise("retryable")


def is_blank_page(kind_: Column, ink: Column) -> Column:
    """A rejection that a nearly blank render explains; unknown ink explains nothing."""
    return kind_.isin(*BLANK_KINDS) & F.coalesce(ink < BLANK_INK, F.lit(False))
