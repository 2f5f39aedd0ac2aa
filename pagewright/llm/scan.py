"""Problem 7: noise that scanning leaves in texts.

Noisy channel: a seen word is a true word passed through character confusions. Which pieces of one or two characters are taken for which, and
how often, is learned from rare words that differ from a common word in one such piece, over all pieces (``alignments``); a short list
(``CONFUSIONS``) is the prior for those that a corpus is too small to show. Word and word-pair counts of the whole corpus give the likelihood
of true words. For each line the candidate words form a trellis that Viterbi decodes. Words split over a line end are joined, running heads,
running feet and page numbers taken out, and broken lines put together.

The lexicon holds the words with at least ``share`` of all words, so it has no more than ``1 / share`` entries at any size of
the corpus; the same holds for the pairs. That is the proven bound of what is broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import all_texts, count_map, map_rows, materialise
from .encoding import LOST, PAGES, decode

#: What a recognizer makes (second) of a true character or pair (first); a prior.
CONFUSIONS = [
    ("e", "c"), ("a", "@"), ("i", "!"), ("o", "0"), ("t", "f"), ("s", "5"), ("l", "1"), ("l", "I"), ("i", "1"), ("i", "l"), ("g", "9"), ("b", "6"), ("z", "2"),
    ("B", "8"), ("S", "5"), ("O", "0"), ("I", "l"), ("I", "1"), ("Z", "2"), ("u", "ii"), ("d", "cl"), ("h", "li"), ("m", "rn"), ("w", "vv"), ("n", "ri"),
    ("rn", "m"), ("cl", "d"), ("vv", "w"), ("ti", "ü"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("ff", "ﬀ"), ("ffi", "ﬃ"),
    ("и", "н"), ("т", "m"), ("о", "0"), ("л", "n"), ("в", "8"), ("В", "8"), ("б", "6"), ("п", "л"), ("ч", "4"), ("з", "3"), ("З", "3"), ("ш", "щ"), ("О", "0"), ("ы", "ьi"),
]
#: What stands before the number in a printed page number.
PAGE_WORDS = ["Page", "page", "p.", "P.", "pp.", "Seite", "S.", "Página", "página", "pág.", "Pág.", "Strona", "strona", "str.", "Str.", "Страница", "страница", "стр.", "Стр.", "с.", "С.", "Feuillet", "Blatt", "Folha", "Hoja", "folio"]

SHARE = 2e-6
PAIR_SHARE = 1e-5
#: Share of all lines that stand alone from which one is a common heading.
TITLE_SHARE = 5e-4
#: A learned confusion shows in so many different words, and in such a share of its true piece's occurrences.
WORDS, RATE = 8, 5e-5
#: Log-odds that a reading other than the word itself must win by.
MARGIN = 1.0
SPLIT = re.compile(r"[-\xad¬‐⸗](?<=[^\W\d_].)[ \t]*\n[ \t]*(?=[^\W\d_])")
PUNCT = ".,;:?…\"“”„«»‘()[]{}<>*_#|`~=+–—•·/\\"
_PAGE = re.compile(r"(?:" + "|".join(map(re.escape, PAGE_WORDS)) + r")[ \xa0]?\d{1,4}(?:[ \xa0](?:of|de|von|sur|z|из|/|sobre|do)[ \xa0]?\d{1,4}|/\d{1,4})?")
_ROMAN = re.compile(r"(?:[-–—] ?)?(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})(?: ?[-–—])?")
_DASHED = re.compile(r"[-–—‒―·•*\[(] ?\d{1,4} ?[-–—‒―·•*\])]")
_DASHES = "-–—‒―·•*[("
_NUMBER = re.compile(r"\d{1,4}")
_BARRED = re.compile(r"\d{1,4} ?\| ?[^\d|]*[^\W\d_][^\d|]*|[^\d|]*[^\W\d_][^\d|]* ?\| ?\d{1,4}")
_HEAD = re.compile(r"([^\d|\t]*?[^\W\d_])[ .…]{2,}(\d{1,4})|(\d{1,4}) {2,}([^\W\d_][^\d|\t]*)")
#: A line without double blanks or bars that may be furniture inside a text: a dashed number, or a title, a full stop and a number.
_INSIDE = re.compile(rf"(?m)^[^\S\n]*{_DASHED.pattern}[^\S\n]*$|[ .…]{{2}}\d{{1,4}}[^\S\n]*$")
_LETTER, _DIGIT = re.compile(r"[^\W\d_]"), re.compile(r"\d")


def stands_alone(p: str) -> bool:
    """Whether a paragraph is one line like a heading: a capital first, no digit, no full stop."""
    return 0 < len(p) <= 60 and p[0].isupper() and "\n" not in p and (p[-1].isalpha() or p[-1] == ")") and not _DIGIT.search(p)


def headings(text: str) -> list[str]:
    """The paragraphs that stand alone like a heading."""
    return [p for p in text.split("\n\n") if stands_alone(p)]


def titled(line: str, titles) -> bool:
    """Whether a line is a common heading with one more name: a running title without a number."""
    head, _, name = line.strip().rpartition(" ")
    return bool(head) and name[:1].isupper() and head in titles and line.strip() not in titles


def furniture(lines: list[str], titles=frozenset()) -> list[int]:
    """Which lines are running heads, running feet or page numbers.

    A bare number, or one of the ``titles`` with a name, is one only at the text's edge.
    """
    filled = [i for i, x in enumerate(lines) if x and not x.isspace()]
    if not filled:
        return []
    first, last, out = filled[0], filled[-1], []
    for i in filled:
        s, edge = lines[i].strip(), i == first or i == last
        if not _DIGIT.search(s):
            if edge and first != last and (len(s) < 12 and _ROMAN.fullmatch(s) or titles and titled(s, titles)):
                out.append(i)
        elif edge and (_NUMBER.fullmatch(s) or _PAGE.fullmatch(s)) or s[0] in _DASHES and _DASHED.fullmatch(s) and (edge or s[0] not in "*(["):
            out.append(i)
        elif "|" in s:
            if s.count("|") == 1 and _BARRED.fullmatch(s) and (edge or not _rows_beside(lines, i, "|")):
                out.append(i)
        elif ("  " in s or ".." in s or "…" in s or " ." in s or ". " in s) and (m := _HEAD.fullmatch(s)):
            title = m[1] or m[4]
            if title == title.upper() and sum(map(str.isalpha, title)) > 2 and ".." not in s:
                out.append(i)
    return out


def _rows_beside(lines: list[str], i: int, sign: str) -> bool:
    return any(0 <= j < len(lines) and sign in lines[j] for j in (i - 1, i + 1))


def is_word(w: str) -> bool:
    return len(w) > 1 and all(c.isalpha() or c in "’'-" for c in w)


def plain_tokens(text: str) -> list[str]:
    """Words as white space splits them, split ones joined, without surrounding punctuation."""
    return [w for w in (x.strip(PUNCT) for x in (SPLIT.sub("", text) if "\n" in text else text).split()) if w]


class Channel:
    """Corpus likelihoods and confusion probabilities; corrects words and lines."""

    def __init__(self, words: dict[str, int], pairs: dict[tuple[str, str], int] | None = None, odds: dict[tuple[str, str], float] | None = None, total: int = 1, titles=frozenset()):
        self.words, self.pairs, self.total, self.titles = words, pairs or {}, max(1, total), titles
        self.odds = odds
        self.longest = max(map(len, words), default=0) + 4  # two confusions add four characters at most
        self.memo: dict[str, list[tuple[str, float]]] = {}
        self.clear: set[str] = set()  # tokens, as white space splits them, that can be nothing else
        self.by_seen: dict[str, list[str]] = defaultdict(list)
        for true, seen in dict.fromkeys([*CONFUSIONS, *(odds or {})]):
            self.by_seen[seen].append(true)

    def chance(self, true: str, seen: str) -> float:
        return 1e-3 if self.odds is None else self.odds.get((true, seen), 1e-7)

    def variants(self, w: str):
        for seen, trues in self.by_seen.items():
            at = w.find(seen)
            while at >= 0:
                for true in trues:
                    yield w[:at] + true + w[at + len(seen) :], true, seen
                at = w.find(seen, at + 1)

    def sources(self, w: str) -> list[tuple[str, float, list[tuple[str, str]]]]:
        """(true word, probability of becoming ``w``, the confusions) for one confusion, or else two."""
        out = {}
        if len(w) > self.longest:
            return []
        for v, a, b in self.variants(w):
            if v in self.words:
                p = self.chance(a, b)
                if v not in out or p > out[v][0]:
                    out[v] = (p, [(a, b)])
        if not out and len(w) > 4 and w not in self.words:
            for v, a, b in self.variants(w):
                for u, c, d in self.variants(v):
                    if u in self.words:
                        p = self.chance(a, b) * self.chance(c, d) * 10
                        if u not in out or p > out[u][0]:
                            out[u] = (p, [(a, b), (c, d)])
        return [(v, p, how) for v, (p, how) in out.items()]

    def candidates(self, w: str) -> list[tuple[str, float]]:
        """True words that ``w`` may be, with the log-probability of word and confusion; empty for most words."""
        got = self.memo.get(w)
        if got is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            n = self.words.get(w, 0)
            got = []
            if 2 < len(w) <= self.longest and sum(map(str.isalpha, w)) > 1:
                got = [(v, math.log(self.words[v] / self.total) + math.log(p)) for v, p, _ in self.sources(w) if self.words[v] * p > n * 0.05 and self.words[v] > 20 * n]
            self.memo[w] = got
        return got

    def itself(self, w: str) -> float:
        """Log-probability of a word as it stands; of an unknown one, that of the rarest kind of word."""
        return math.log((self.words.get(w, 0) + 1e-3) / self.total)

    def _pair(self, a: str, b: str) -> float:
        """How much likelier ``b`` is after ``a`` than anywhere."""
        n = self.pairs.get((a, b))
        if not n:
            return -1.0 if a in self.words and b in self.words else 0.0
        return math.log(n * self.total / (self.words.get(a, n) * self.words.get(b, n)))

    def decode(self, cores: list[str]) -> list[str]:
        """The likeliest true words of a line."""
        choices = [[(w, self.itself(w) + MARGIN)] + self.candidates(w) if w else [("", 0.0)] for w in cores]
        if all(len(c) == 1 for c in choices):
            return cores
        best: list[tuple[float, list[str]]] = [(p, [w]) for w, p in choices[0]]
        for options in choices[1:]:
            best = [max(((q + p + self._pair(path[-1], w), [*path, w]) for q, path in best), key=lambda x: x[0]) for w, p in options]
        return max(best, key=lambda x: x[0])[1]

    def line_is_code(self, line: str) -> bool:
        return " = " in line or "(" in line and line.lstrip().startswith(("print", "if ", "for "))

    def misread(self, text: str) -> bool:
        """Whether any line decodes to other words."""
        cand = self.candidates
        rest = set(text.split()) - self.clear
        if not rest:
            return False
        if len(self.clear) > 300_000:
            self.clear.clear()
        doubtful = {w for w in rest if cand(w.strip(PUNCT))}
        self.clear |= rest - doubtful
        if not doubtful:
            return False
        for line in text.split("\n"):
            if self.line_is_code(line):
                continue
            cores = [x.strip(PUNCT) for x in line.split()]
            if any(cand(w) for w in cores if w) and self.decode(cores) != cores:
                return True
        return False

    def repair(self, text: str) -> tuple[str, int, int, int]:
        """(repaired text, furniture lines, joined words, corrected words)."""
        lines = text.split("\n")
        heads = set(furniture(lines, self.titles))
        kept, n_heads = [x for i, x in enumerate(lines) if i not in heads], len(heads)
        joined, n_split = SPLIT.subn("", "\n".join(kept))
        n_fixed, out = 0, []
        for para in re.split(r"\n[ \t]*\n", joined):
            rows = [x for x in para.split("\n") if x.strip()]
            flowing = len(rows) > 1 and not any("\t" in x or "  " in x.strip() or self.line_is_code(x) or re.match(r"\s*(?:[•*+-]|\(?\w{1,3}[.)]|[|<{\\])\s?", x) for x in rows)
            done = []
            for row in [" ".join(x.strip() for x in rows)] if flowing else rows:
                if not self.line_is_code(row):
                    parts = row.split(" ")
                    cores = [x.strip(PUNCT) for x in parts]
                    if any(self.candidates(w) for w in cores if w):
                        for i, (a, b) in enumerate(zip(cores, self.decode(cores))):
                            if a != b:
                                parts[i] = parts[i].replace(a, b, 1)
                                n_fixed += 1
                        row = " ".join(parts)
                done.append(row)
            if done:
                out.append("\n".join(done))
        return "\n\n".join(out), n_heads, n_split, n_fixed


def corpus_counts(texts: DataFrame) -> DataFrame:
    """``a, b, n``: counts of tokens with letters (b is empty), of lines that stand alone (b is a line end) and of pairs of
    neighbouring words."""

    def start():
        def work(cols, out: Counter):
            words, pairs = Counter(), Counter()
            for text in cols[0]:
                if text:
                    ws = plain_tokens(text)
                    words.update(ws)
                    for line in headings(text):
                        out[line, "\n"] += 1
                    pairs.update(zip(ws, ws[1:]))
            good = {w for w in words if is_word(w)}
            for w, n in words.items():
                if w in good or len(w) > 3 and _LETTER.search(w):
                    out[w, ""] += n
            for (a, b), n in pairs.items():
                if a in good and b in good:
                    out[a, b] += n

        return work

    return count_map(texts, "a string, b string", ["text"], start)


def _pieces(words: DataFrame) -> DataFrame:
    """``key, piece`` and the columns of ``words`` for each inner piece of one or two characters of ``a``; ``key`` is alike where all but the
    piece is."""
    n = F.length("a")
    cut = lambda i, k: F.struct(F.xxhash64(F.substring("a", F.lit(1), i), F.substr(F.col("a"), i + k + 1)).alias("key"), F.substring("a", i + 1, k).alias("piece"))
    both = F.flatten(F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(2), n - 1 - i)), lambda k: cut(i, k))))
    return words.where(n >= 4).select("*", F.explode(both).alias("_p")).select("*", "_p.key", "_p.piece").drop("_p")


def alignments(tokens: DataFrame, floor: float, longest: int) -> DataFrame:
    """``true, seen, e, words``: how often a piece of a common word stands as another in rare tokens, and in how many words (in: ``a, n``).

    Only pieces inside a word are compared: its beginning and end are inflected. A rare token's count is shared out among the common words it
    may be. Tokens longer than a common word can become are left out, which changes nothing. Three letters at least stand around a piece, so a
    key has few common words.
    """
    common = tokens.where((F.col("n") >= floor) & (F.length("a") >= 5) & F.col("a").rlike(r"^[\p{L}’'-]+$"))
    true = _pieces(common.select("a", "n")).select("key", F.col("a").alias("word"), F.col("n").alias("m"), F.col("piece").alias("true"))
    seen = _pieces(tokens.where(F.length("a") <= longest)).withColumnRenamed("piece", "seen")
    ends = lambda f: f("true", F.lit(1)) != f("seen", F.lit(1))
    pairs = seen.join(true, "key").where((F.col("m") > 50 * F.col("n")) & ends(F.left) & ends(F.right))
    mass = F.sum("m").over(Window.partitionBy("a"))
    e = pairs.select("true", "seen", "word", (F.col("n") * F.col("m") / mass).alias("e"))
    return e.groupBy("true", "seen").agg(F.sum("e").alias("e"), F.countDistinct("word").alias("words"))


def swapped(true: str, seen: str) -> bool:
    """Whether one is the other read in a wrong code page, or lost: that is no misreading but a wrong decoding."""
    if LOST in seen:
        return True
    for page in ("utf-8", *PAGES):
        try:
            data = true.encode(page)
        except UnicodeError:
            continue
        if any(page != other and decode(data, other) == seen for other in PAGES):
            return True
    return False


def learn(texts: DataFrame, share: float = SHARE, pair_share: float = PAIR_SHARE, least: int = 4) -> Channel:
    """Lexicon, pairs and confusion probabilities from all texts."""
    counts = materialise(corpus_counts(texts.where("text is not null")), "p7-counts")
    total = counts.where("b = ''").agg(F.sum("n")).first()[0] or 0
    floor = max(least, share * total)
    common = counts.where(F.col("n") >= floor)
    words = {r.a: r.n for r in common.where("b = ''").select("a", "n").toLocalIterator() if is_word(r.a)}
    lines = counts.where("b = '\\n'")
    alone = lines.agg(F.sum("n")).first()[0] or 0
    titles = frozenset(r.a for r in lines.where(F.col("n") >= max(least, TITLE_SHARE * alone)).collect())
    pairs = {(r.a, r.b): r.n for r in common.where(~F.col("b").isin("", "\n") & (F.col("n") >= pair_share * total)).toLocalIterator()}
    times: Counter = Counter()
    for w, n in words.items():
        for k in (1, 2):
            for i in range(len(w) - k + 1):
                times[w[i : i + k]] += n
    # Pairs of pieces of one or two characters: their number is bounded by the alphabets.
    aligned = alignments(counts.where("b = ''").select("a", "n"), floor, max(map(len, words), default=0) + 1).where(F.col("words") >= WORDS).collect()
    odds = {(r.true, r.seen): r.e / times[r.true] for r in aligned if times[r.true] and r.e >= RATE * times[r.true] and not swapped(r.true, r.seen)}
    first = Channel(words, odds=odds, total=total)
    shared = texts.sparkSession.sparkContext.broadcast(first)

    def start():
        channel = shared.value

        def work(cols, out: Counter):
            for w, n in zip(*cols):
                known = channel.words.get(w, 0)
                got = [(v, how) for v, _, how in channel.sources(w) if len(how) == 1 and channel.words[v] > 50 * max(n, known)]
                mass = sum(channel.words[v] for v, _ in got)
                for v, how in got:
                    out[how[0][0], how[0][1]] += round(1000 * n * channel.words[v] / mass)

        return work

    # Anywhere in a word, for the confusions that are known by now.
    for r in count_map(counts.where("b = ''"), "true string, seen string", ["a", "n"], start).collect():
        odds[r.true, r.seen] = r.n / 1000 / max(1, times[r.true])
    return Channel(words, pairs, {k: min(0.05, max(1e-6, p)) for k, p in odds.items()}, total, titles)


def _flag(channel: Channel, text: str) -> bool:
    if SPLIT.search(text):
        return True
    lines = text.split("\n")
    if "  " in text or "|" in text:  # a running head may stand anywhere
        if furniture(lines, channel.titles):
            return True
    else:
        filled = [x for x in lines if x.strip()]
        if len(filled) > 1 and (len(filled[0]) < 101 or len(filled[-1]) < 101) and furniture([filled[0], filled[-1]], channel.titles):
            return True
        if len(filled) == 1 and furniture(filled):
            return True
        if _INSIDE.search(text) and furniture(lines, channel.titles):
            return True
    return channel.misread(text)


def scan_flags(texts: DataFrame, channel: Channel) -> DataFrame:
    """``tbl, record_id, is_case`` of each non-null text."""
    shared = texts.sparkSession.sparkContext.broadcast(channel)

    def start():
        channel = shared.value

        def work(cols):
            keep = [i for i, t in enumerate(cols[2]) if t is not None]
            return {"tbl": [cols[0][i] for i in keep], "record_id": [cols[1][i] for i in keep], "is_case": [_flag(channel, cols[2][i]) for i in keep]}

        return work

    return map_rows(texts, "tbl string, record_id bigint, is_case boolean", ["tbl", "record_id", "text"], start)


def repaired_texts(texts: DataFrame, channel: Channel) -> DataFrame:
    """``tbl, record_id, repaired, n_heads, n_joined, n_corrected``; a null text stays null."""
    shared = texts.sparkSession.sparkContext.broadcast(channel)

    def start():
        channel = shared.value

        def work(cols):
            done = [(None, 0, 0, 0) if t is None else channel.repair(t) for t in cols[2]]
            return {"tbl": cols[0], "record_id": cols[1], "repaired": [d[0] for d in done], "n_heads": [d[1] for d in done], "n_joined": [d[2] for d in done], "n_corrected": [d[3] for d in done]}

        return work

    return map_rows(texts, "tbl string, record_id bigint, repaired string, n_heads int, n_joined int, n_corrected int", ["tbl", "record_id", "text"], start)


def p7_found(spark, sf_dir):
    texts = all_texts(spark, sf_dir)
    return scan_flags(texts, learn(texts)).where("is_case").select("tbl", "record_id")


def p7_repaired(spark, sf_dir):
    """Every record's text as continuous paragraphs, with the number of repairs."""
    texts = all_texts(spark, sf_dir)
    return repaired_texts(texts, learn(texts))
