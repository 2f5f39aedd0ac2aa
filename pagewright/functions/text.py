"""Text metrics as column expressions; they stay in the JVM.

Classes are written out (``[\\p{L}\\p{N}_]`` for a word character, ``SPACE`` for white space), since the short forms of Java know
ASCII alone.
"""

from __future__ import annotations

from unicodedata import category

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"[\p{L}\p{N}_]+"
STRIP = r"\[\](){}.,;:!?\"'"


def _digits() -> str:
    """The class of decimal digits and of the signs that Unicode counts as digits too, such as superscripts."""
    more = [c for c in map(chr, range(0x20000)) if c.isdigit() and category(c) != "Nd"]
    return r"\p{Nd}" + "".join(f"\\x{{{ord(c):X}}}" for c in more)


DIGIT = _digits()


def strip(text: Column) -> Column:
    """White space off both ends, Unicode's included."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def space_tokens(text: Column) -> Column:
    """Tokens as white space parts them; none for a blank text."""
    return F.filter(F.split(text, rf"[{SPACE}]+"), lambda t: t != "")


def words(text: Column) -> Column:
    """Runs of word characters, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def is_garbage(token: Column) -> Column:
    """Whether a token looks like recognition garbage: a run of four equal characters, over 40 characters, letters with digits,
    three or more letters without a vowel unless all are capitals, or two changes from lower to upper case."""
    # What is stripped holds neither letters nor digits: only the length needs the core, and most tokens end at the first test.
    core = F.regexp_replace(token, rf"^[{STRIP}]+|[{STRIP}]+$", "")
    few_vowels = ~token.rlike("[aeiouyAEIOUY]") & token.rlike(r"\p{L}[^\p{L}]*\p{L}[^\p{L}]*\p{L}") & (token.rlike(r"\p{Ll}") | ~token.rlike(r"\p{Lu}"))
    return (
        token.rlike(r"(?s)(.)\1{3,}|\p{Ll}\p{Lu}.*\p{Ll}\p{Lu}")
        | few_vowels
        | (token.rlike(f"[{DIGIT}]") & token.rlike(r"\p{L}"))
        | ((F.length(token) > 40) & (F.length(core) > 40))
    )


def garbage_fraction(text: Column) -> Column:
    """Share of garbage among the tokens; null for a blank or null text."""
    t = space_tokens(text)
    return F.try_divide(F.size(F.filter(t, is_garbage)).cast("double"), F.when(F.size(t) > 0, F.size(t)).cast("double"))


def normalize_markdown(text: Column) -> Column:
    """Link texts without their targets, no marks of emphasis, headings, quotes or code, single blanks; case is kept."""
    t = F.regexp_replace(text, r"\[([^\]]*)\]\([^)]*\)", "$1")
    t = F.regexp_replace(t, r"[#*_>`~]", "")
    return strip(F.regexp_replace(t, rf"[{SPACE}]+", " "))


def spam_share(text: Column, spam_words: list[str]) -> Column:
    """Share of words of a spam list; 0 without words."""
    w = F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "), " "), lambda x: x != "")
    return F.coalesce(F.try_divide(F.size(F.filter(w, lambda x: x.isin(*spam_words))).cast("double"), F.size(w).cast("double")), F.lit(0.0))


def perplexity(sum_logprob: Column, n_tokens: Column) -> Column:
    """``exp(-sum / n)``; null, never NaN, where no token was scored."""
    return F.when(n_tokens > 0, F.exp(-sum_logprob / n_tokens))


def markdown_path(source: Column) -> Column:
    """Where a source's Markdown goes: a tarball's member under the tarball's name, no empty or parent parts, ``.md`` at the end."""
    base = F.element_at(F.split(F.split_part(source, F.lit("::"), F.lit(1)), "/"), -1)
    stem = F.regexp_replace(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""), r"\.tar$", "")
    inner = F.regexp_replace(source, r"(?s)^.*?::", "")
    relative = F.when(source.contains("::"), F.concat(stem, F.lit("/"), inner)).otherwise(source)
    parts = F.filter(F.split(relative, "/"), lambda p: (p != "") & (p != ".."))
    name = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    folder = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.array_join(F.concat(F.array(F.lit("markdown")), folder, F.array(F.concat(name, F.lit(".md")))), "/")


def metrics_url(server: Column) -> Column:
    """The metrics address beside an API address."""
    bare = F.regexp_replace(server, "/+$", "")
    return F.concat(F.regexp_replace(F.regexp_replace(bare, "/v1$", ""), "/+$", ""), F.lit("/metrics"))


def sanitize_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\p{L}\p{N}_]+", "_")


def format_rate(rate: Column) -> Column:
    """``-`` for no measurement, thousands with a k."""
    return F.when(rate.isNull(), "-").when(rate >= 1000, F.concat(F.format_string("%.1f", rate / 1000), F.lit("k"))).otherwise(F.format_string("%.0f", rate))


def elapsed(seconds: Column) -> Column:
    """``HH:MM:SS``; hours do not wrap."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def raw_text_of_prompt(prompt: Column) -> Column:
    """What stands between the text marks of a prompt; an error without them."""
    pattern = r"(?s)RAW_TEXT_START\s*\n(.*?)\nRAW_TEXT_END"
    return F.when(prompt.rlike(pattern), strip(F.regexp_extract(prompt, pattern, 1))).otherwise(F.raise_error(F.lit("prompt has no raw text")))


def png_size(base64: Column) -> Column:
    """``struct<width, height>`` from the header of a base64 PNG."""
    data = F.unbase64(base64)
    number = lambda at: F.conv(F.hex(F.substring(data, at, 4)), 16, 10).cast("int")
    return F.struct(number(17).alias("width"), number(21).alias("height"))


def sniff(content: Column) -> Column:
    """'png', 'jpeg', 'pdf' or null from the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    return F.when(head == "89504E470D0A1A0A", "png").when(head.startswith("FFD8"), "jpeg").when(head.startswith("25504446"), "pdf")


def is_tarball(path: Column) -> Column:
    return F.lower(path).rlike(r"(\.tar\.gz|\.tgz)$")
