"""Problem 1: text garbled by a wrong character decoding.

Each source's garbling is an unknown substitution cipher: a true letter is written as one or more wrong characters. The
hidden letters of a word follow the corpus' character bigrams, the cipher writes them; expectation-maximization over the
distinct suspicious words learns, for each source, how often each letter is written as each unit. Which letters a unit may
stand for comes from code pages: the bytes that give the unit in one page, read in another. A word whose best reading uses the
cipher is garbled; ``str.translate`` (and replacement of longer units) gives the text back. U+FFFD has lost its letter: it is
named and only guessed where the bigrams leave no doubt.

Counts cover all texts. They are made map-side; what reaches the driver are tables over characters, whose size depends on
alphabets and code pages alone, times the number of sources.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache
from operator import ne

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import all_texts, count_map, map_rows, materialise

#: The letters beyond ASCII of the languages at hand, and signs that running text uses.
LETTERS = {
    "de": "äöüßÄÖÜ",
    "fr": "àâæçéèêëîïôœùûüÿÀÂÆÇÉÈÊËÎÏÔŒÙÛÜŸ",
    "es": "áéíñóúüÁÉÍÑÓÚÜ",
    "pt": "ãáàâçéêíóôõúÃÁÀÂÇÉÊÍÓÔÕÚ",
    "pl": "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ",
    "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюяёАБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ",
}
SIGNS = "’‘“”„‚«»–—…•°£€§№¿¡ºª×©®™±½¼²³µ·\xa0"
#: Signs a page may hold as they are, though no code page swap aims at them.
PLAIN = "\xad‐‑¬−→←≤≥≈≠−′″†‡"
LOST = "�"
#: Code pages that took part in swaps, as Python names them; cp1252 with its gaps filled by control characters, as browsers do.
PAGES = ["cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "iso8859-5", "mac-roman", "mac-cyrillic", "cp437", "cp850", "cp852", "iso8859-15"]
TARGET = frozenset("".join(LETTERS.values()) + SIGNS)
BASE = TARGET | frozenset(chr(i) for i in range(9, 127)) | frozenset(PLAIN)
ALPHABETIC = frozenset("".join(LETTERS.values()))
CYRILLIC = frozenset(LETTERS["ru"])

#: Log-probability a cipher unit starts with; of any unit that learning has not met.
START, FLOOR = math.log(3e-3), math.log(1e-7)
#: Log-odds of a word in capitals whose letters are otherwise known only in lower case.
CAPITALS = math.log(1e-3)
#: A word of usual characters all of whose bigrams are likelier than this needs no other reading.
CLEAR = -9.5
#: Readings of a word's beginning that lie so far below the best are not followed.
BEAM = 16.0
SMOOTH = 0.5


def decode(data: bytes, page: str) -> str | None:
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(page))
        except UnicodeDecodeError:
            if page != "cp1252":
                return None
            out.append(chr(b))
    return "".join(out)


@lru_cache(1)
def units() -> tuple[dict[str, frozenset[str]], dict[str, frozenset[str]]]:
    """(units of several characters, single characters) with the letters each may stand for."""
    many: dict[str, set[str]] = defaultdict(set)
    one: dict[str, set[str]] = defaultdict(set)
    for letter in TARGET:
        data = letter.encode()
        for page in PAGES:
            wrong = decode(data, page)
            if wrong and wrong != letter and not wrong.isascii():
                many[wrong].add(letter)
                for again in ("cp1252", "latin-1"):
                    twice = decode(wrong.encode(), again)
                    if twice:
                        many[twice].add(letter)
    for b in range(0x80, 0x100):
        shown = {page: decode(bytes([b]), page) for page in PAGES}
        for wrong in shown.values():
            for letter in shown.values():
                if wrong and letter and wrong != letter and letter in TARGET and letter != "\xa0":
                    one[wrong].add(letter)
    return {k: frozenset(v) for k, v in many.items() if len(k) > 1}, {k: frozenset(v) for k, v in one.items()}


def tokens(text: str) -> list[str]:
    return [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]


#: Signs that stand inside a word, before one, or after one, only by accident. Short units of measure may end in one.
_ODD_SIGN = re.compile(r"[^\W\d_][£€§¿¡ºª×©®™±½¼²³µ«»„“”•…°][^\W\d_]|(?<!\w)[ºª×®™±½¼²³µ·°…][^\W\d_]{2}|[^\W\d_]{3}[£€§¿¡ºª×©±½¼²³µ„](?!\w)")


def _has_unit(word: str, many) -> bool:
    return any(word[i : i + k] in many for i, c in enumerate(word) if not c.isascii() for k in (2, 3, 4, 5, 6))


class Reader:
    """Reads words against character bigrams and the ciphers of sources."""

    def __init__(self, bigrams: dict[str, int], theta: dict[tuple[str, str, str], float] | None = None):
        first: Counter = Counter()
        letters: Counter = Counter()
        for ab, n in bigrams.items():
            first[ab[0]] += n
            letters[ab[1]] += n
        total = sum(letters.values()) + 1
        self.log = {ab: math.log((n + SMOOTH * (letters[ab[1]] + 0.1) / total) / (first[ab[0]] + SMOOTH)) for ab, n in bigrams.items()}
        self.back = {a: math.log(SMOOTH / (n + SMOOTH)) for a, n in first.items()}
        self.letter = {b: math.log((n + 0.1) / total) for b, n in letters.items()}
        self.rare = math.log(0.1 / total)
        self.theta = theta
        self.many, self.one = units()
        self.counts = letters
        self.memo: dict[tuple[str, str], tuple[bool, str, bool]] = {}
        self.clear: dict[str, set[str]] = defaultdict(set)  # of each source, tokens that are not garbled

    def step(self, a: str, b: str) -> float:
        x = self.log.get(a + b)
        return self.back.get(a, 0.0) + self.letter.get(b, self.rare) if x is None else x

    def plain(self, word: str) -> float:
        """Log-probability of a word as it stands."""
        p, a = 0.0, " "
        for b in word + " ":
            p += self.step(a, b)
            a = b
        return p

    def _usual(self, word: str) -> bool:
        log = self.log
        w = f" {word} "
        if all(log.get(x, FLOOR) > CLEAR for x in map(str.__add__, w, w[1:])):
            return True
        w = w.lower()
        return w != f" {word} " and all(log.get(x, FLOOR) > CLEAR for x in map(str.__add__, w, w[1:]))

    def _emit(self, source: str, unit: str, letter: str) -> float:
        if self.theta is None:
            return START
        x = self.theta.get((source, unit, letter))
        return self.theta.get(("", unit, letter), FLOOR) if x is None else x

    def lattice(self, source: str, word: str) -> list[list[tuple[int, str, str, float]]]:
        """From each position the readings (length, unit, letter, log-probability); unit '' is a character read as itself."""
        n, out = len(word), []
        alone = sum(not c.isascii() for c in word) == 1 and not any(c in ALPHABETIC or c.isascii() and c.isalpha() for c in word)
        for i, c in enumerate(word):
            arcs = [(1, "", c, 0.0)]
            if not c.isascii() and c != LOST:  # every unit begins with a character beyond ASCII
                for k in range(2, min(7, n - i + 1)):
                    unit = word[i : i + k]
                    arcs += [(k, unit, x, self._emit(source, unit, x)) for x in self.many.get(unit, ())]
                if len(arcs) == 1:  # the bytes of UTF-8 seldom meet by chance: where they do, single signs are no rival
                    arcs += [(1, c, x, self._emit(source, c, x)) for x in self.one.get(c, ()) if not (alone and x in ALPHABETIC)]
            out.append(arcs)
        return out

    def expect(self, source: str, word: str) -> Counter:
        """Posterior of each cipher arc (unit, letter) of a word, from a forward and a backward pass."""
        arcs, n = self.lattice(source, word), len(word)
        ahead: list[dict[str, float]] = [{} for _ in range(n + 1)]
        ahead[0][" "] = 0.0
        for i in range(n):
            least = max(ahead[i].values(), default=0.0) - BEAM
            for a, p in ahead[i].items():
                if p < least:
                    continue
                for k, _, x, e in arcs[i]:
                    q = p + e + self.step(a, x)
                    old = ahead[i + k].get(x)
                    ahead[i + k][x] = q if old is None else max(q, old) + math.log1p(math.exp(-abs(q - old)))
        behind: list[dict[str, float]] = [{} for _ in range(n + 1)]
        behind[n] = {a: self.step(a, " ") for a in ahead[n]}
        out: Counter = Counter()
        if not ahead[n]:
            return out
        top = max(p + behind[n][a] for a, p in ahead[n].items())
        total = top + math.log(sum(math.exp(p + behind[n][a] - top) for a, p in ahead[n].items()))
        for i in range(n - 1, -1, -1):
            least = max(ahead[i].values(), default=0.0) - BEAM
            for a, p in ahead[i].items():
                if p < least:
                    continue
                b = None
                for k, unit, x, e in arcs[i]:
                    rest = behind[i + k].get(x)
                    if rest is None:
                        continue
                    q = e + self.step(a, x) + rest
                    b = q if b is None else max(q, b) + math.log1p(math.exp(-abs(q - b)))
                    if unit:
                        r = p + q - total
                        if r > -12:
                            out[unit, x] += math.exp(r)
                if b is not None:
                    behind[i][a] = b
        return out

    def read(self, source: str, word: str) -> tuple[bool, str, bool]:
        """(garbled, the restored word, whether all letters could be restored), from the likeliest reading."""
        key = (source, word)
        if key in self.memo:
            return self.memo[key]
        if len(self.memo) > 200_000:
            self.memo.clear()
        n = len(word)
        if word.isascii() or BASE.issuperset(word) and self._usual(word) and not _has_unit(word, self.many):
            best = (False, word, True)
        else:
            stands = max(self.plain(word), self.plain(word.lower()) + CAPITALS)
            arcs = self.lattice(source, word)
            at: list[dict[str, tuple[float, tuple | None]]] = [{} for _ in range(n + 1)]
            at[0][" "] = (0.0, None)
            for i in range(n):
                least = max((p for p, _ in at[i].values()), default=0.0) - BEAM
                for a, (p, _) in at[i].items():
                    if p < least:
                        continue
                    for k, unit, x, e in arcs[i]:
                        q = p + e + self.step(a, x)
                        if x not in at[i + k] or q > at[i + k][x][0]:
                            at[i + k][x] = (q, (i, a, unit))
            end = max(at[n], key=lambda a: at[n][a][0] + self.step(a, " "))
            likeliest = at[n][end][0] + self.step(end, " ")
            path, i, a = [], n, end
            while i:
                _, (j, b, unit) = at[i][a]
                path.append((j, i, unit, a))
                i, a = j, b
            path.reverse()
            lost = LOST in word
            # A swap leaves no Cyrillic letter of a word as it was: a word that is part itself is a fragment or misread.
            part = any(not u and x in CYRILLIC for _, _, u, x in path) and all(u in ALPHABETIC for _, _, u, _ in path if u)
            garbled = lost or any(u for _, _, u, _ in path) and likeliest > stands and not part
            single = {ord(u): x for _, _, u, x in path if len(u) == 1}
            same = all(word[i] not in map(chr, single) for i, _, u, _ in path if not u) and len({(u, x) for _, _, u, x in path if len(u) == 1}) == len(single)
            if not garbled:
                done = word
            elif not lost and same:  # one substitution for the word: longer units first, the rest by translate
                done = word
                for u, x in sorted({(u, x) for _, _, u, x in path if len(u) > 1}, key=lambda p: -len(p[0])):
                    done = done.replace(u, x)
                done = done.translate(single)
            else:
                done = "".join(x if x != LOST else self._guess(path, k) for k, (_, _, _, x) in enumerate(path))
            best = (garbled, done, LOST not in done)
        self.memo[key] = best
        return best

    def _guess(self, path, k: int) -> str:
        """The letter of a lost character if its neighbours leave little doubt, else U+FFFD."""
        a = path[k - 1][3] if k else " "
        b = path[k + 1][3] if k + 1 < len(path) else " "
        if LOST in (a, b):
            return LOST
        odds = sorted(((self.step(a, x) + self.step(x, b), x) for x in TARGET), reverse=True)
        return odds[0][1] if odds[0][0] - odds[1][0] > 3.0 else LOST


def corpus_counts(texts: DataFrame) -> DataFrame:
    """``kind, source, s, n``: counts of character bigrams (kind b) and of words with other than ASCII characters (kind w)."""
    many, _ = units()

    def start():
        def work(cols, out: Counter):
            seen: dict[str, Counter] = defaultdict(Counter)
            for source, text in zip(*cols):
                if text:
                    seen[source or ""].update(tokens(text))
            for source, words in seen.items():
                for w, n in words.items():
                    if not w.isascii():
                        out["w", source, w] += n
                        if not BASE.issuperset(w) or _ODD_SIGN.search(w) or _has_unit(w, many):
                            continue
                    low = w.lower()
                    if low != w and sum(map(ne, low, w)) > 3:  # a swap inside one script shows as capitals
                        continue
                    a = " "
                    for b in w + " ":
                        out["b", "", a + b] += n
                        a = b

        return work

    return count_map(texts, "kind string, source string, s string", ["model", "text"], start)


def learn(texts: DataFrame, rounds: int = 12, weight: float = 5.0, settled: float = 0.01) -> Reader:
    """Character bigrams and the ciphers of all sources.

    Rounds go on until no more than a share ``settled`` of the expected counts has moved from one unit's letter to another's, ``rounds`` at most.
    The driver receives tables over pairs of characters and over (source, unit, letter), bounded by alphabets and code pages.
    """
    counts = materialise(corpus_counts(texts.where("text is not null")), "p1-counts")
    bigrams = {r.s: r.n for r in counts.where("kind = 'b'").select("s", "n").toLocalIterator()}
    if not bigrams:
        return Reader({}, {})
    base = Reader(bigrams)

    def pick():
        def work(cols):
            keep = [i for i, w in enumerate(cols[1]) if LOST not in w and (not BASE.issuperset(w) or not base._usual(w) or _has_unit(w, base.many))]
            return {"source": [cols[0][i] for i in keep], "s": [cols[1][i] for i in keep], "n": [cols[2][i] for i in keep]}

        return work

    words = materialise(map_rows(counts.where("kind = 'w'"), "source string, s string, n bigint", ["source", "s", "n"], pick), "p1-words")
    theta, before = None, {}
    for _ in range(rounds):
        reader = Reader(bigrams, theta)

        def start(reader=reader):
            def work(cols):
                c: Counter = Counter()
                for source, w, n in zip(*cols):
                    for (u, x), p in reader.expect(source, w).items():
                        c[source, u, x] += n * p
                ks = list(c)
                return {"source": [k[0] for k in ks], "unit": [k[1] for k in ks], "letter": [k[2] for k in ks], "e": [c[k] for k in ks]}

            return work

        e = map_rows(words, "source string, unit string, letter string, e double", ["source", "s", "n"], start)
        rows = e.groupBy("source", "unit", "letter").agg(F.sum("e").alias("e")).where("e > 0.01").toLocalIterator()
        expected: dict[tuple[str, str, str], float] = {(r.source, r.unit, r.letter): r.e for r in rows}
        pooled: Counter = Counter()
        sources: Counter = Counter()
        for (s, u, x), v in expected.items():
            pooled[u, x] += v
            sources[s] += v
        n = base.counts
        theta = {("", u, x): math.log((v + 1e-3) / (n[x] + v + 1)) for (u, x), v in pooled.items()}
        share = 1.0 / max(1, len(sources))
        for (s, u, x), v in expected.items():
            p = math.exp(theta["", u, x])
            theta[s, u, x] = math.log((v + weight * p) / (n[x] * share + v + weight))
        moved = sum(abs(expected.get(k, 0.0) - before.get(k, 0.0)) for k in expected.keys() | before.keys())
        if moved <= 2 * settled * sum(expected.values()):
            break
        before = expected
    return Reader(bigrams, theta)


def _flag(reader: Reader, source: str, text: str) -> bool:
    if text.isascii():
        return False
    if LOST in text:
        return True
    read, clear = reader.read, reader.clear[source]
    rest = set(tokens(text)) - clear
    if len(clear) > 200_000:
        clear.clear()
    for w in rest:
        if not w.isascii() and read(source, w)[0]:
            return True
        clear.add(w)
    return False


def restore(reader: Reader, source: str, text: str) -> tuple[str, int, bool]:
    """(text with garbled words restored, number of them, whether every letter was restored)."""
    if text.isascii():
        return text, 0, True
    out, n, whole = [], 0, True
    for line in text.split("\n"):
        cells = []
        for cell in line.split("\t"):
            words = cell.split(" ")
            for i, w in enumerate(words):
                if w and not w.isascii():
                    bad, done, all_back = reader.read(source, w)
                    if bad:
                        words[i], n, whole = done, n + 1, whole and all_back
            cells.append(" ".join(words))
        out.append("\t".join(cells))
    return "\n".join(out), n, whole


def encoding_flags(texts: DataFrame, reader: Reader) -> DataFrame:
    """``tbl, record_id, is_case`` of each non-null text."""

    def start():
        def work(cols):
            keep = [i for i, t in enumerate(cols[3]) if t is not None]
            return {"tbl": [cols[0][i] for i in keep], "record_id": [cols[1][i] for i in keep], "is_case": [_flag(reader, cols[2][i] or "", cols[3][i]) for i in keep]}

        return work

    return map_rows(texts, "tbl string, record_id bigint, is_case boolean", ["tbl", "record_id", "model", "text"], start)


def restored_texts(texts: DataFrame, reader: Reader) -> DataFrame:
    """``tbl, record_id, restored, n_words, complete``; a null text stays null."""

    def start():
        def work(cols):
            done = [(None, 0, True) if t is None else restore(reader, m or "", t) for m, t in zip(cols[2], cols[3])]
            return {"tbl": cols[0], "record_id": cols[1], "restored": [d[0] for d in done], "n_words": [d[1] for d in done], "complete": [d[2] for d in done]}

        return work

    return map_rows(texts, "tbl string, record_id bigint, restored string, n_words int, complete boolean", ["tbl", "record_id", "model", "text"], start)


def p1_found(spark, sf_dir):
    texts = all_texts(spark, sf_dir)
    return encoding_flags(texts, learn(texts)).where("is_case").select("tbl", "record_id")


def p1_restored(spark, sf_dir):
    """The garbled records with their restored text."""
    texts = all_texts(spark, sf_dir)
    return restored_texts(texts, learn(texts)).where("n_words > 0").select("tbl", "record_id", "restored", "n_words", "complete")
