"""Problem 10: per-document text quality statistics.

A hidden Markov model labels each line prose, list, table or junk. A line is described by a few discrete statistics (what it
begins and ends with, columns, length, shares of common words, digits and signs); given its label they are taken as independent.
Emissions and transitions start from a bounded sample of hand-labelled documents (``LABELLED``), every line with the document's
label, and are re-estimated by Viterbi training, in which the document's label is only evidence, since some labels are wrong
and prose holds short lists. A document's kind is the label with most of its characters.

Figures that SQL can express (``text_statistics``) are built-in column expressions.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, read, spread, word_languages

LABELS = ("prose", "list", "table", "junk")
#: Labelled documents that the model is fitted to, picked by hash.
LABELLED = 2_000
ROUNDS = 4
#: Log-odds that a document's own label adds to each of its lines while the model is fitted.
TRUST = 1.2

_BULLET = re.compile(r"\s*[•‣◦▪·*+–—-]\s")
_ENUM = re.compile(r"\s*(?:\(?(?:\d{1,3}|[A-Za-zА-Яа-я]|[ivxlc]{1,5})[.)]|№ ?\d+\.?)\s")
_REF = re.compile(r"\s*\[\d{1,4}\]\s")
_LEADER = re.compile(r"(?:\.{4,}|(?: \.){4,}|…{2,}|_{4,})\s*\d+\s*$")
_INDEX = re.compile(r"[^\d,;]{2,50}(?:, ?\d{1,4}(?:[-–]\d{1,4})?)+\s*$")
_KEY = re.compile(r"[^\W\d_][^:\n]{0,40}: \S")
_FULL = re.compile(r"[.!?…][\"”»’“)\]]*\s*$")
_WORDS = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][\d!@#$%^&*|;~<>={}\[\]\\+/]+[^\W\d_]|\d[^\W\d_]|[!|;~][^\W\d_]")
_GAP = re.compile(r" {2,}")
_DIGITS = re.compile(r"\d+")
_ODD = re.compile(r"[\d!@#$%^&*|;~<>={}\[\]\\+/]")


def columns(line: str) -> tuple[str, int]:
    """(separator, number of cells) of a line: the separator that gives most cells, one cell without any."""
    s = line.strip()
    best = ("", 1)
    for sep in ("\t", ";", "|"):
        if sep in s and (n := s.count(sep) + 1) > best[1]:
            best = (sep, n)
    if "  " in s and (n := len(_GAP.findall(s)) + 1) > best[1]:
        best = ("  ", n)
    return best


def _entry(line: str) -> bool:
    """Whether a line is as short as an entry and has no full stop."""
    s = line.strip()
    return 0 < len(s) < 60 and not _FULL.search(s[-6:])


def describe(line: str, before: tuple[str, int], after: tuple[str, int], known, beside: int = 0) -> tuple[tuple[int, ...], tuple[str, int]]:
    """(the discrete statistics of a line, its columns); ``before`` and ``after``: the columns of its neighbours,
    ``beside``: how many lines directly next to it look like entries."""
    s = line.strip()
    n = len(s)
    cols = columns(line)
    runs = _WORDS.findall(s.lower())
    letters = sum(map(len, runs))
    words = [w for w in runs if len(w) > 1]
    common = sum(map(known.__contains__, words))
    odd = _ODD.search(s)
    digits = sum(map(len, _DIGITS.findall(s))) if odd else 0
    blanks = s.count(" ") + s.count("\t")
    signs = n - digits - letters - blanks
    begin = 1 if _BULLET.match(line) else 2 if _ENUM.match(line) else 3 if _REF.match(line) else 0
    numbered = s[-1].isdigit()
    shape = 1 if numbered and _LEADER.search(s[-200:]) else 2 if numbered and _INDEX.fullmatch(s) else 3 if _KEY.match(s) else 0
    same = cols[1] >= 3 and (cols == before or cols == after)
    end = 1 if _FULL.search(s[-6:]) else 2 if s[-1].isdigit() or s[-1] == "%" else 3 if s[-1] in "-‐¬" else 0
    tokens = s.split()
    mixed = len(_MIXED.findall(s)) / max(1, len(tokens)) if odd else 0.0
    share = bisect_right((1e-9, 0.12, 0.25, 0.4), common / len(words)) if len(words) > 2 else 5 if not words else 6
    return (
        begin, shape, min(cols[1], 4) + 4 * same, end,
        share * 5 + bisect_right((18, 34, 50, 110), n),
        bisect_right((0.03, 0.08, 0.16, 0.3), signs / n),
        bisect_right((1e-9, 0.1, 0.25, 0.45), digits / n),
        bisect_right((2.2, 3.5, 8.0, 12.0), letters / max(1, len(tokens))),
        bisect_right((1e-9, 0.15, 0.4), mixed),
        2 if letters > 3 and s == s.upper() and s != s.lower() else int(letters > 3 and s[:1].islower()),
        (1 + beside if _entry(line) else 0) * 3 + (0 if not words else 1 if not common else 2),
    ), cols


def described(text: str, known) -> list[tuple[tuple[int, ...], int]]:
    """(statistics, number of characters) of each line that is not blank."""
    rows = ["", *text.split("\n"), ""]
    at = [i for i, x in enumerate(rows) if x.strip()]
    cols = [columns(rows[i]) for i in at]
    entry = [_entry(x) for x in rows]
    none = ("", 1)
    return [(describe(rows[i], cols[k - 1] if k else none, cols[k + 1] if k + 1 < len(at) else none, known, entry[i - 1] + entry[i + 1])[0], len(rows[i].strip())) for k, i in enumerate(at)]


class LineModel:
    """Emissions, transitions and starts over ``LABELS``; decodes lines by Viterbi."""

    def __init__(self, emit: list[list[Counter]], move: list[list[float]], start: list[float]):
        k = len(LABELS)
        self.emit = emit  # label -> statistic -> counts
        self.total = [[sum(c.values()) for c in emit[j]] for j in range(k)]
        self.move = [[math.log(x / sum(row)) for x in row] for row in move]
        self.into = [list(x) for x in zip(*self.move)]
        self.start = [math.log(x / sum(start)) for x in start]
        self.memo: dict[tuple[int, ...], list[float]] = {}

    def lines(self, f: tuple[int, ...]) -> list[float]:
        got = self.memo.get(f)
        if got is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            got = self.memo[f] = [sum(math.log((c[x] + 0.3) / (t + 6)) for c, t, x in zip(e, ts, f)) for e, ts in zip(self.emit, self.total)]
        return got

    def decode(self, feats: list[tuple[int, ...]], trust: tuple[int, float] | None = None) -> list[int]:
        if not feats:
            return []
        k = range(len(LABELS))
        scores, back = None, []
        for f in feats:
            e = self.lines(f)
            if trust:
                e = [x + trust[1] * (j == trust[0]) for j, x in enumerate(e)]
            if scores is None:
                scores = [self.start[j] + e[j] for j in k]
                continue
            step, new = [], []
            for into, x in zip(self.into, e):
                reach = [a + b for a, b in zip(scores, into)]
                m = max(reach)
                step.append(reach.index(m))
                new.append(m + x)
            back.append(step)
            scores = new
        at = max(k, key=scores.__getitem__)
        path = [at]
        for step in reversed(back):
            at = step[at]
            path.append(at)
        return path[::-1]


def fit(docs: list[tuple[str, list[tuple[int, ...]]]], rounds: int = ROUNDS) -> LineModel:
    """Viterbi training on (label, line statistics) of documents."""
    labels = [[LABELS.index(kind)] * len(feats) for kind, feats in docs]
    model = None
    for r in range(rounds + 1):
        width = 11
        emit = [[Counter() for _ in range(width)] for _ in LABELS]
        move = [[20.0 if i == j else 1.0 for j in range(len(LABELS))] for i in range(len(LABELS))]
        start = [1.0] * len(LABELS)
        for (_, feats), path in zip(docs, labels):
            for f, j in zip(feats, path):
                for c, x in zip(emit[j], f):
                    c[x] += 1
            for i, j in zip(path, path[1:]):
                move[i][j] += 1
            if path:
                start[path[0]] += 1
        model = LineModel(emit, move, start)
        if r < rounds:
            labels = [model.decode(feats, (LABELS.index(kind), TRUST)) for kind, feats in docs]
    return model


def train(documents: DataFrame, kinds: DataFrame, known, labelled: int = LABELLED) -> LineModel:
    """Model from a bounded sample of hand labels. A document with several labels takes the commonest, ties the first by name.

    Without labels every line is as likely one kind as another, and ties go to prose.
    """
    ids = kinds.where(F.col("kind").isin(*LABELS) & F.col("doc_id").isNotNull())
    votes = ids.distinct().groupBy("doc_id", "kind").agg(F.count("*").alias("n"))
    one = votes.groupBy("doc_id").agg(F.min(F.struct(-F.col("n"), "kind"))["kind"].alias("kind"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    rows = documents.where("text is not null").join(F.broadcast(picked), "doc_id").select("kind", "doc_id", "text").collect()  # at most ``labelled`` rows
    return fit([(r.kind, [f for f, _ in described(r.text, known)]) for r in sorted(rows, key=lambda r: r.doc_id)])


def document_kinds(documents: DataFrame, model: LineModel, known) -> DataFrame:
    """``doc_id, n_lines, share_prose, share_list, share_table, share_junk, kind``; shares of characters by line label.

    A null text, or one of blank lines only, has no shares and no kind (null).
    """
    shared = documents.sparkSession.sparkContext.broadcast((model, known))

    def start():
        model, known = shared.value

        def work(cols):
            out = {"doc_id": cols[0], "n_lines": [], **{f"share_{k}": [] for k in LABELS}, "kind": []}
            for text in cols[1]:
                lines = described(text, known) if text else []
                mass = [0] * len(LABELS)
                for j, (_, n) in zip(model.decode([f for f, _ in lines]), lines):
                    mass[j] += n
                total = sum(mass)
                out["n_lines"].append(len(lines))
                for k, m in zip(LABELS, mass):
                    out[f"share_{k}"].append(m / total if total else None)
                other = max(range(1, len(LABELS)), key=mass.__getitem__)
                out["kind"].append((LABELS[other] if 2 * mass[0] < total else "prose") if total else None)
            return out

        return work

    schema = "doc_id bigint, n_lines int, " + ", ".join(f"share_{k} double" for k in LABELS) + ", kind string"
    return map_rows(documents, schema, ["doc_id", "text"], start)


def text_statistics(text: Column, common: list[str]) -> dict[str, Column]:
    """Counts, mean word length, shares of signs, of lines that end with a full stop and of common words; null for a null text, 0 without words."""
    words = F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    n_words, n_lines, n_chars = F.size(words), F.size(lines), F.length(text)
    bare = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))
    zero = lambda x: F.round(F.coalesce(x.cast("double"), F.lit(0.0)), 6)
    out = {
        "n_words": n_words.cast("bigint"), "n_lines": n_lines.cast("bigint"),
        "mean_word_length": zero(F.try_divide(F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)).cast("double"), n_words.cast("double"))),
        "symbol_ratio": zero(F.try_divide(F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]", "")).cast("double"), n_chars.cast("double"))),
        "punctuated_lines": zero(F.try_divide(F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"[.!?:;]$"))).cast("double"), n_lines.cast("double"))),
        "common_share": zero(F.try_divide(F.size(F.filter(bare, lambda w: w.isin(*common) if common else F.lit(False))).cast("double"), n_words.cast("double"))),
    }
    return {k: F.when(text.isNotNull(), v) for k, v in out.items()}


def _kinds(spark, sf_dir):
    docs = spread(read(spark, sf_dir, "documents", "doc_id", "text"))
    known = frozenset(word_languages(read(spark, sf_dir, "common_words")))
    return document_kinds(docs, train(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "doc_kinds"), known), known)


def p10_found(spark, sf_dir):
    return _kinds(spark, sf_dir).where("kind <> 'prose'").select("doc_id", "kind")


def p10_kinds(spark, sf_dir):
    """Every document's shares by line label."""
    k = _kinds(spark, sf_dir)
    return k.select("doc_id", "n_lines", *[F.round(f"share_{x}", 6).alias(f"share_{x}") for x in LABELS], "kind")


def p10_stats(spark, sf_dir):
    common = sorted(word_languages(read(spark, sf_dir, "common_words")))
    docs = spread(read(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", *[c.alias(k) for k, c in text_statistics(F.col("text"), common).items()])


STATS_SQL = """
with w as (
  select doc_id, text, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> '') as words,
         list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') as lines
  from documents),
c as (select list(distinct lower(word)) as common from common_words where word is not null and lang is not null)
select doc_id, len(words)::bigint as n_words, len(lines)::bigint as n_lines,
  round(case when len(words) = 0 then 0.0 else list_sum(list_transform(words, lambda x: length(x)))::double / len(words) end, 6) as mean_word_length,
  round(case when length(text) = 0 then 0.0 else length(regexp_replace(text, '[\\p{L}\\p{N}\\s]', '', 'g'))::double / length(text) end, 6) as symbol_ratio,
  round(case when len(lines) = 0 then 0.0 else len(list_filter(lines, lambda x: regexp_matches(rtrim(x), '[.!?:;]$')))::double / len(lines) end, 6) as punctuated_lines,
  round(case when len(words) = 0 then 0.0 else len(list_filter(words, lambda x: list_contains(common, lower(regexp_replace(x, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g')))))::double / len(words) end, 6) as common_share
from w, c
"""
