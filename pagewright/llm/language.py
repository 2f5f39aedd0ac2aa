"""Problem 3: missing or wrong language labels.

Hierarchical discrimination on sentences: linear support vector machines over hashed character n-grams first tell the
language family, then one-versus-one machines tell the languages within it. A decision is a sum over a sentence's words, so
each distinct word is scored once a task. The machines are fitted on a bounded sample of labelled documents (``PER_LANGUAGE``
documents of each language, picked by hash); sentences whose label the first fit contradicts are left out of the second.
Everything else covers all rows and whole texts.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LANGS, label_language, map_rows, read, settled_texts

#: Documents of each language in the training sample, and sentences of each.
PER_LANGUAGE, SENTENCES = 300, 6
BITS = 16
FAMILIES = {"germanic": ("en", "de"), "romance": ("fr", "es", "pt"), "slavic": ("pl", "ru")}
#: The machines: three for the families, one for each pair within a family.
PAIRS = [(a, b) for members in FAMILIES.values() for i, a in enumerate(members) for b in members[i + 1 :]]
N = len(FAMILIES) + len(PAIRS)
#: How labels spell the languages.
NAMES = {
    "en": ("en", "eng", "english"), "de": ("de", "deu", "ger", "german"), "fr": ("fr", "fra", "fre", "french"), "es": ("es", "spa", "spanish", "castilian"),
    "pt": ("pt", "por", "portuguese"), "pl": ("pl", "pol", "polish"), "ru": ("ru", "rus", "russian"),
}
#: Code pages in which a garbled sentence may have been read, and those it was written in.
SWAPS = [("cp1252", "utf-8"), ("latin-1", "utf-8"), ("mac-roman", "utf-8"), ("cp437", "utf-8"), ("cp850", "utf-8"), ("cp1250", "utf-8"), ("cp1251", "utf-8"), ("cp866", "utf-8"), ("koi8-r", "utf-8"),
         ("latin-1", "cp1251"), ("cp1252", "cp1251"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("cp866", "koi8-r"), ("latin-1", "koi8-r"), ("mac-roman", "cp1251")]
#: A sentence counts from so many words, so many of two letters or more (the letters of a formula are no words), confidence and share of known n-grams.
LEAST_WORDS, LEAST_LONG, SURE, KNOWN = 4, 3, 0.7, 0.6

_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"(?<=[.!?…])[\"”»’)\]*_']*\s+(?=[\"“„«¿¡(\[*_'—-]*[^\W\d_a-zà-öø-ÿа-яёąćęłńóśźż])")
_FULL = re.compile(r"[.!?][\"”»’“)\]*_'`~}]*$")
_TAG = re.compile(r"<[^<>\n]*>|&nbsp;|\\[a-z]+\*?\{|\{\{[^{}]*\}\}")
_SPLIT = re.compile(r"[-\xad¬‐](?<=\w.)\n(?=\w)")


def sentences(text: str) -> list[str]:
    """Full sentences of running text, lines of a paragraph joined. Headings, table rows, code and formulas have no full stop."""
    if "<" in text or "&" in text or "\\" in text or "{{" in text:
        text = _TAG.sub(" ", text)
    if "\n" in text:
        text = _SPLIT.sub("", text)
    out = []
    for para in text.split("\n\n"):
        if "." in para or "?" in para or "!" in para:
            if "\t" in para:
                para = "\n".join(x for x in para.split("\n") if "\t" not in x)
            for s in _END.split(para.replace("\n", " ")):
                s = s.strip()
                if _FULL.search(s):
                    out.append(s)
    return out


def ngrams(word: str) -> list[int]:
    w = f" {word} ".encode("utf-16-le")
    n = len(w) // 2
    mask = (1 << BITS) - 1
    return [zlib.crc32(w[2 * i : 2 * (i + k)], k) & mask for k in (2, 3, 4) for i in range(n - k + 1)] + [zlib.crc32(w, 9) & mask]


def words_of(sentence: str) -> list[str]:
    """Distinct words: one that is said over and over must not decide alone."""
    return list(dict.fromkeys(w.lower() for w in _WORD.findall(sentence)))


def whole(words: list[str]) -> bool:
    """Whether words are enough for a sentence."""
    return len(words) >= LEAST_WORDS and sum(len(w) > 1 for w in words) >= LEAST_LONG


class Machines:
    """Weights (features x machines) and which features the training met."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, met: np.ndarray):
        self.weights, self.bias, self.met = weights, bias, met

    def start(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores sentences; keeps the sums of words it has met."""

    def __init__(self, machines: Machines):
        self.m = machines
        self._empty()

    def _empty(self):
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, N + 2), np.float32)

    def _row(self, word: str) -> int:
        i = self.index[word] = len(self.index)
        if i == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        f = ngrams(word)
        self.rows[i, :N] = self.m.weights[f].sum(0)
        self.rows[i, N] = len(f)
        self.rows[i, N + 1] = self.m.met[f].sum()
        return i

    def score(self, sents: list[list[str]]) -> list[tuple[str, float, float]]:
        """(language, confidence, share of known n-grams) of each sentence, given as words; ('', 0, 0) without words."""
        if len(self.index) > 200_000:
            self._empty()
        index, row = self.index, self._row
        ids, starts, which = [], [], []
        for k, ws in enumerate(sents):
            if ws:
                starts.append(len(ids))
                which.append(k)
                ids += [index[w] if w in index else row(w) for w in ws]
        out = [("", 0.0, 0.0)] * len(sents)
        if not ids:
            return out
        s = np.add.reduceat(self.rows[ids], starts, axis=0)
        d = s[:, :N] / np.sqrt(s[:, N : N + 1]) + self.m.bias
        known = s[:, N + 1] / s[:, N]
        names = list(FAMILIES)
        fam = d[:, :3]
        first = fam.argmax(1)
        top = np.sort(fam, axis=1)
        margin = top[:, 2] - top[:, 1]
        for k, f, gap, row_, kn in zip(which, first.tolist(), margin.tolist(), d[:, 3:].tolist(), known.tolist()):
            wins = dict.fromkeys(FAMILIES[names[f]], 0.0)
            least = dict.fromkeys(wins, 9.0)
            for (a, b), x in zip(PAIRS, row_):
                if a in wins:
                    for lang, y in ((a, x), (b, -x)):
                        wins[lang] += (y > 0) + 1e-3 * y
                        least[lang] = min(least[lang], y)
            lang = max(wins, key=wins.__getitem__)
            sure = min(gap, 2 * max(0.0, least[lang]))
            out[k] = (lang, 1 / (1 + math.exp(-2.5 * sure)), kn)
        return out

    def languages(self, sents: list[str]) -> list[tuple[str, float, float]]:
        """As ``score`` for sentences as text; one with few known n-grams is read through other code pages first."""
        out = self.score([words_of(s) for s in sents])
        for i, (_, _, known) in enumerate(out):
            if known < KNOWN and not sents[i].isascii():
                other = [t for t in (reread(sents[i], a, b) for a, b in SWAPS) if t]
                if other:
                    best = max(self.score([words_of(t) for t in other]), key=lambda x: x[2])
                    if best[2] > max(known + 0.2, 0.75):
                        out[i] = best
        return out


def reread(s: str, seen: str, written: str) -> str | None:
    """The sentence with its words turned back from one code page into another; words that cannot be are left out."""
    out = []
    for w in s.split():
        try:
            data = b"".join(c.encode(seen) if ord(c) > 0x9F or c.isascii() else bytes([ord(c)]) for c in w)
            t = data.decode(written)
            if t != w and written == "utf-8" and not t.isascii() and any(0xC0 <= ord(c) <= 0xFF for c in t):
                try:  # garbled twice
                    t = b"".join(c.encode(seen) if ord(c) > 0x9F or c.isascii() else bytes([ord(c)]) for c in t).decode(written)
                except (UnicodeError, ValueError):
                    pass
            out.append(t)
        except (UnicodeError, ValueError):
            continue
    return " ".join(out) if len(out) > 2 else None


def fit(samples: list[tuple[str, list[str]]], epochs: int = 4, seed: int = 7) -> Machines:
    """Averaged stochastic subgradient descent on the hinge loss, all machines at once. ``samples``: (language, words)."""
    data = []
    for lang, ws in samples:
        f = np.array([x for w in ws for x in ngrams(w)], np.int64)
        if len(f):
            ids, n = np.unique(f, return_counts=True)
            y = np.zeros(N, np.float32)
            for k, members in enumerate(FAMILIES.values()):
                y[k] = 1 if lang in members else -1
            for k, (a, b) in enumerate(PAIRS):
                y[3 + k] = 1 if lang == a else -1 if lang == b else 0
            data.append((lang, ids, (n / math.sqrt(len(f))).astype(np.float32), y))
    met = np.zeros(1 << BITS, np.float32)
    for _, ids, _, _ in data:
        met[ids] = 1
    share = {lang: max(1, sum(d[0] == lang for d in data)) for lang in LANGS}
    for _ in range(2):
        w, total, bias = np.zeros((1 << BITS, N), np.float32), np.zeros((1 << BITS, N), np.float32), np.zeros(N, np.float32)
        rng, t = np.random.default_rng(seed), 0
        steps = max(1, epochs * len(data))
        for _ in range(epochs):
            for i in rng.permutation(len(data)):
                lang, ids, v, y = data[i]
                hit = (y * (v @ w[ids] + bias) < 1) * y
                if hit.any():
                    rate = 0.1 / math.sqrt(1 + t / len(data)) * min(3.0, len(data) / len(LANGS) / share[lang])
                    step = rate * hit
                    d = v[:, None] * step
                    w[ids] += d
                    total[ids] += d * (1 - t / steps)  # a step counts in the average for the time it lasts
                    bias += 0.1 * step
                t += 1
        m = Machines(total, bias, met)
        agreed = []
        got = m.start().score([ws for _, ws in samples]) if data else []
        for (lang, ws), (guess, sure, _) in zip(samples, got):
            if guess == lang or sure < 0.75:
                agreed.append((lang, ws))
        if len(agreed) == len(samples):
            break
        keep = {id(ws) for _, ws in agreed}
        data = [d for d, (_, ws) in zip(data, [s for s in samples if s[1]]) if id(ws) in keep]
    return m


def train(documents: DataFrame, per_language: int = PER_LANGUAGE, per_document: int = SENTENCES) -> Machines:
    """Machines from a bounded sample of labelled documents: at most ``per_language`` of each language, picked by hash.

    Null ids, texts and labels give no sample; without any sample the machines know nothing and name no language.
    """
    docs = documents.where(F.col("lang").isin(*LANGS) & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    n = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not n:
        return Machines(np.zeros((1 << BITS, N), np.float32), np.zeros(N, np.float32), np.zeros(1 << BITS, np.float32))
    picked = None
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    for lang, k in n.items():
        one = (F.col("lang") == lang) & (h < min(1_000_000, int(1.2e6 * per_language / k) + 1))
        picked = one if picked is None else picked | one
    rows = sorted((r.lang, r.doc_id, r.text) for r in docs.where(picked).select("lang", "doc_id", "text").collect())
    samples, used = [], dict.fromkeys(LANGS, 0)
    for lang, _, text in rows:
        if used[lang] < per_language:
            ss = [ws for ws in map(words_of, sentences(text)) if whole(ws)]
            used[lang] += bool(ss)
            step = max(1, len(ss) // per_document)
            samples += [(lang, ws) for ws in ss[::step][:per_document]]
    return fit(samples)


def languages(responses: DataFrame, machines: Machines) -> DataFrame:
    """``response_id, label, lang, confidence, stretches`` of each response.

    ``stretches``: runs of sentences of one language with confidence, number of sentences and of characters. A null text or one without sentences
    has no language (null, confidence 0) and no stretches.
    """
    shared = responses.sparkSession.sparkContext.broadcast(machines)

    def start():
        scorer = shared.value.start()

        def work(cols):
            rid, label, texts = cols
            per = [sentences(t) if t else [] for t in texts]
            got = iter(scorer.languages([s for ss in per for s in ss]))
            out = {"response_id": rid, "label": [label_language(re.sub(r"[\s(].*", "", x.strip()) if x else x, NAMES) for x in label], "lang": [], "confidence": [], "stretches": []}
            for ss in per:
                runs, mass = [], {}
                for s in ss:
                    lang, sure, known = next(got)
                    if not lang or known < KNOWN:
                        continue
                    mass[lang] = mass.get(lang, 0.0) + sure * len(s)
                    full = sure >= SURE and whole(words_of(s))
                    if runs and runs[-1]["lang"] == lang:
                        r = runs[-1]
                        r["confidence"] = max(r["confidence"], sure)
                        r["sentences"] += 1
                        r["chars"] += len(s)
                        r["full"] = r["full"] or full
                    else:
                        runs.append({"lang": lang, "confidence": sure, "sentences": 1, "chars": len(s), "full": full})
                top = max(mass, key=mass.__getitem__) if mass else None
                out["lang"].append(top)
                out["confidence"].append(mass[top] / sum(mass.values()) if mass else 0.0)
                out["stretches"].append(runs)
            return out

        return work

    schema = "response_id bigint, label string, lang string, confidence double, stretches array<struct<lang:string,confidence:double,sentences:int,chars:int,full:boolean>>"
    return map_rows(responses, schema, ["response_id", "primary_language", "natural_text"], start)


def _languages(spark, sf_dir):
    r = settled_texts(read(spark, sf_dir, "page_responses", "response_id", "ingested_at", "primary_language", "natural_text"), ["response_id"], "ingested_at")
    return languages(r, train(read(spark, sf_dir, "documents", "doc_id", "lang", "text")))


def p3_found(spark, sf_dir):
    # The languages of full sentences that the label does not name.
    one = _languages(spark, sf_dir).select("response_id", "label", F.array_distinct(F.transform(F.filter("stretches", lambda x: x["full"]), lambda x: x["lang"])).alias("langs"))
    return one.select("response_id", "label", F.explode("langs").alias("lang")).where("label is null or label <> lang").select("response_id", "lang")


def p3_languages(spark, sf_dir):
    """Every response's language and confidence, and its stretches."""
    return _languages(spark, sf_dir).select("response_id", "label", "lang", F.round("confidence", 6).alias("confidence"), F.to_json("stretches").alias("stretches"))
