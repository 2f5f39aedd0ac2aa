"""Problem 6: texts that lost their end.

A backward character n-gram model is trained on all texts: for a context of up to eight characters, how often a complete unit
(paragraph, list item, table row) ends there, and how often the text goes on, within the word or after it. The log-odds of the
two at a text's final context, with running feet, closing markup and cut marks set aside, are compared with a threshold of the
text's language and run: a low quantile of the log-odds at ends that are surely complete. Two facts follow as exact checks: a
length at which a run's texts pile up is a field limit; and a page that other runs end with the same words, or whose
sentence goes on at the head of the next page, is complete.

Contexts are told apart by fingerprints, so one that never occurred backs off to a shorter one. Of each order the commonest contexts are kept,
``KEPT`` at most, so the broadcast model has a bounded size on any corpus; a rarer one backs off as an unseen one does.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import FLUSH, materialise, read, settled_texts, with_group, word_languages
from .scan import TITLE_SHARE, furniture, stands_alone, titled

ORDERS = (2, 3, 4, 6, 8)
#: Bits of a fingerprint; the greatest number of contexts of an order.
BITS = 60
KEPT = 1 << 20
#: Weight of the shorter context in the mixture.
KAPPA = 2.0
#: Quantile of complete ends that gives a threshold, and the limits of a threshold.
QUANTILE, LOWEST, HIGHEST = 0.01, -6.0, -3.0
_DIGITS = re.compile(r"\d+")
_LISTY = re.compile(r"\s*(?:[•*+|!<\\-]|\(?\w{1,3}[.)]\s)|.*(?:\t|   |\|| = )")
_TAIL = re.compile(
    r"(?:</?[A-Za-z][^<>\n]*>|<ref>[^<>]*</ref>|<!--[^<>]*-->|\{\{[^{}]*\}\}|\[\^[^\]]*\]|\\(?:label|ref|footnote|cite)\{[^{}]*\}|\\end\{\w+\}|!\[[^\]]*\]\([^()]*\)|\$[^$\n]*\\[^$\n]*\$|\\\([^\n]*?\\\))\s*\Z"
)
#: Ends of lists and tables: what they close is whole.
_WHOLE = re.compile(r"</(?:table|ul|ol)>|\\end\{(?:tabular|itemize|enumerate)\}")
_MARKS = ("…", "...", "]")
_MARK = re.compile(r"\[\s*(?:…|\.\.\.)\s*\]\Z|…\Z|\.\.\.\Z")
_CLOSERS = frozenset(">}])$")
_SIGNS = "*_`~'"
_STOP, _QUOTES = frozenset(".!?"), "\"”»’“)]"
#: Last characters of words that may end a sentence.
_ENDERS = _STOP | frozenset(_QUOTES)
#: Characters that are compared at a full stop; how many more words another run has to hold after them.
LAST, BEYOND = 32, 15
_STOPS = re.compile(r"[.!?]+(?=[\"”»’“)\]]*(?:\s|\Z))")
_WORDS = re.compile(r"\w+")


def _without_feet(body: str) -> str:
    """A text without the running feet and page numbers at its end."""
    while (at := body.rfind("\n")) >= 0:
        last = body[at + 1 :]
        if not (_DIGITS.search(last) or len(last) < 12):
            break
        two = body[:at].rsplit("\n", 2)[-2:]
        f = furniture([*two, last])
        if not f or f[-1] != len(two):
            break
        body = body[:at].rstrip()
    return body


def _without_signs(body: str) -> tuple[str, bool, bool]:
    """(a text without closing markup and cut marks at its end, whether there was a cut mark, whether it ends with a whole list or table)."""
    mark = whole = False
    while True:
        last = body[-1:]
        if last in _CLOSERS and (m := _TAIL.search(body)) and m.group(0).strip():
            whole = whole or not mark and bool(_WHOLE.match(m.group(0)))
            body = body[: m.start()].rstrip()
        elif body.endswith(_MARKS) and (m := _MARK.search(body)):
            body, mark = body[: m.start()].rstrip(), True
        elif last in _SIGNS and last and (less := body.rstrip(_SIGNS)):
            body = less
        elif last == "}" and (less := body.rstrip("}")):
            body = less
        else:
            return body, mark, whole


def endings(text: str) -> list[tuple[str | None, str, bool, bool]]:
    """(last line, the text up to its own last character, whether a cut mark followed, whether a list or table was closed): first of the whole text, then, as long as the last line
    may be a running title without a number, of the text without it. The last of the list has no such line."""
    body, out = text.rstrip(), []
    while True:
        body = _without_feet(body)
        at = body.rfind("\n")
        line = body[at + 1 :].strip()
        name = line.rpartition(" ")[2] if at >= 0 else ""
        foot = line if name[:1].isupper() and name != line and stands_alone(line[: -len(name) - 1]) else None
        out.append((foot, *_without_signs(body)))
        if foot is None:
            return out
        body = body[:at].rstrip()


def context(before: str) -> str:
    """The last characters before an end, numbers alike, white space as one blank."""
    ws = before.rsplit(None, 2)[-2:]
    a, b = ("", *ws)[-2:] if ws else ("", "")
    return _pair(_plain(a)[-7:], _plain(b))


def _plain(word: str) -> str:
    return _DIGITS.sub("0", word.lower())


def _pair(a: str, b: str) -> str:
    return f" {a} {b}" if a else f" {b}"


def closed(body: str) -> bool:
    """Whether a text ends with a full stop, a question or an exclamation."""
    return body[-1:] in _ENDERS and body.rstrip(_QUOTES)[-1:] in _STOP


_MIX = 0x9E3779B97F4A7C15


def _buckets(columns: list[np.ndarray], size: int) -> np.ndarray:
    """The fingerprints of many contexts at once: ``columns`` hold the codes of each place, the last of a context in the last, 0 where it is short."""
    h = np.zeros(size, np.uint64)
    for c in [np.uint64(0)] * (ORDERS[-1] - len(columns)) + columns:
        h = (h ^ c) * np.uint64(_MIX)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def units_of(para: str) -> tuple[str, ...] | list[str]:
    """The units of a paragraph: its lines if it is a list or a table, else the whole."""
    if "\n" in para:
        units = para.split("\n")
        if all(map(_LISTY.match, units)):
            return units
    return (para,)


def _key(words: str) -> int:
    return zlib.crc32(words.encode()) - (1 << 31)


def stops(words: list[str]) -> list[int]:
    """Keys of the last characters before each full stop that the text, given as words in lower case, holds once and goes on well past."""
    if len(words) <= BEYOND:
        return []
    text = " ".join(words)
    at = [k for k in [m.start() for m in _STOPS.finditer(text)] if k >= LAST]
    keys = [_key(text[k - LAST : k]) for k in at]
    most = len(text) - len(" ".join(words[-BEYOND:]))
    if len(set(keys)) == len(keys):
        return keys[: bisect_left(at, most)]
    n = Counter(keys)
    return [x for k, x in zip(at, keys) if k < most and n[x] == 1]


def last_key(body: str) -> int | None:
    """The key of a text's last characters before its full stop; None if there are fewer, or no full stop."""
    if not closed(body):
        return None
    ws = " ".join(body.lower().rsplit(None, LAST)[-LAST:]).rstrip(_QUOTES).rstrip(".!?")
    return _key(ws[-LAST:]) if len(ws) >= LAST else None


#: Numbers of the beginning and of the end of a unit among the words of a task; of the end of what may be cut.
_START, _END, _CUT = 0, 1, 2


class _Numbers(dict):
    """Words in lower case, numbered as they come."""

    def __init__(self, first: Iterable[str] = ()):
        super().__init__()
        self.words: list[str] = ["", "", "", *first]
        self.update((w, i) for i, w in enumerate(self.words) if i > _CUT)

    def __missing__(self, word: str) -> int:
        plain = _DIGITS.sub("0", word)
        if plain != word:
            n = self[word] = self[plain]
        else:
            n = self[word] = len(self.words)
            self.words.append(word)
        return n


FEATURES = (
    "response_id bigint, model string, doc bigint, page int, lang string, length int, n_words int, head_low boolean, "
    "foot array<string>, context array<string>, mark array<boolean>, whole array<boolean>, closed array<boolean>, tail array<bigint>, last array<int>, inner array<string>, stops array<int>"
)
#: The columns of the endings of a text: one entry for each of ``endings``.
_ENDINGS = ("foot", "context", "mark", "whole", "closed", "tail", "last")
COUNTS = "a string, b string, how string, n bigint"


def read_texts(responses: DataFrame, common: DataFrame) -> DataFrame:
    """One pass over all texts: a row of features (``FEATURES``) for each response with text, and rows of counts (``COUNTS``, how not null).

    The counts are of pairs of neighbouring words within a unit (how w), of the pairs at the ends of units (how e), and of lines that stand
    alone (how t). The last unit of a text may be cut: its final word is not counted. A task numbers its words and counts pairs of numbers; it
    emits and empties its tables when they are large. Null and blank texts have no row.
    """
    known = word_languages(common)
    langs = sorted({x for v in known.values() for x in v})
    speaks = np.array([[x in v for x in langs] for v in known.values()], bool).reshape(len(known), len(langs))
    target = to_arrow_schema(StructType.fromDDL(f"{FEATURES}, {COUNTS}"))
    names = StructType.fromDDL(FEATURES).fieldNames()
    lists = {f.name for f in target if pa.types.is_list(f.type)}

    def languages(ids: np.ndarray, owner: np.ndarray, n: int) -> list[str]:
        """Of each text the language that has most of its frequent words; '' without any. Ties go to the first code."""
        few = (ids > _CUT) & (ids <= _CUT + len(known))
        if not few.any():
            return [""] * n
        which, word = owner[few], ids[few] - _CUT - 1
        score = np.stack([np.bincount(which, speaks[word, k], n) for k in range(len(langs))], 1)
        return [langs[k] if some else "" for k, some in zip(score.argmax(1).tolist(), score.any(1).tolist())]

    def emit(numbers: _Numbers, flat: list[int], alone: Counter) -> pa.RecordBatch:
        x = np.array(flat, np.int64)
        a, b = x[:-1], x[1:]
        # An end goes with the two words before it; a cut text's end and its last word go with nothing.
        ends = np.flatnonzero(b == _END)
        pair = (b > _CUT) & ((a > _CUT) | (a == _START)) & (np.append(b[1:], 0) != _CUT)
        out = {"a": list(alone), "b": [""] * len(alone), "how": ["t"] * len(alone), "n": list(alone.values())}
        words, tails = np.array(numbers.words, object), np.array([w[-7:] for w in numbers.words], object)
        for how, p, q in (("w", a[pair], b[pair]), ("e", x[np.maximum(ends - 1, 0)], x[ends])):
            keys, n = np.unique(p << 32 | q, return_counts=True)
            out["a"] += tails[keys >> 32].tolist()
            out["b"] += words[keys & 0xFFFFFFFF].tolist()
            out["how"] += [how] * len(keys)
            out["n"] += n.tolist()
        size = len(out["n"])
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if f.name in out else pa.nulls(size, f.type) for f in target], schema=target)

    def run(batches):
        numbers, flat, alone = _Numbers(known), [_CUT], Counter()
        for batch in batches:
            out = {k: [] for k in names}
            offsets = {k: [0] for k in lists}
            began, sizes, get, at = len(flat), [], numbers.__getitem__, numbers.words
            for rid, model, doc, page, text in zip(*[c.to_pylist() for c in batch.columns]):
                if text is None or text.isspace() or not text:
                    continue
                words, ends, new, start = [], out["inner"], False, len(flat)
                for para in text.split("\n\n"):
                    if len(para) <= 60 and stands_alone(para):
                        alone[para] += 1
                    for unit in units_of(para) if "\n" in para else (para,):
                        ws = unit.lower().split()
                        if ws:
                            flat.append(_START)
                            flat.extend(map(get, ws))
                            words += ws
                            new = not closed(ws[-1])  # of the last unit, which may be cut, the end does not count
                            if new:
                                ends.append(_pair(at[flat[-2]][-7:], at[flat[-1]])[-ORDERS[-1] :])
                            flat.append(_END)
                flat[-1] = _CUT
                if new:
                    ends.pop()
                sizes.append(len(flat) - start)
                for foot, body, mark, whole in endings(text):
                    last_three = " ".join(_WORDS.findall(" ".join(body.rsplit(None, 3)[-3:]).lower())[-3:])
                    for k, v in zip(_ENDINGS, (foot, context(body)[-ORDERS[-1] :], mark, whole, closed(body), zlib.crc32(last_three.encode()), last_key(body))):
                        out[k].append(v)
                out["stops"] += stops(words)
                for k in lists:
                    offsets[k].append(len(out[k]))
                for k, v in (("response_id", rid), ("model", model or ""), ("doc", doc), ("page", page), ("length", len(text)), ("n_words", len(words)), ("head_low", _head(text)[:1].islower())):
                    out[k].append(v)
            size = len(sizes)
            out["lang"] = languages(np.array(flat[began:], np.int64), np.repeat(np.arange(size), sizes), size)
            cols = []
            for f in target:
                if f.name in lists:
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets[f.name], pa.int32()), pa.array(out[f.name], f.type.value_type)))
                else:
                    cols.append(pa.array(out[f.name], f.type) if f.name in out else pa.nulls(size, f.type))
            yield pa.RecordBatch.from_arrays(cols, schema=target)
            if len(flat) > 20 * FLUSH or len(numbers) > FLUSH:
                yield emit(numbers, flat, alone)
                numbers, flat, alone = _Numbers(known), [_CUT], Counter()
        yield emit(numbers, flat, alone)

    columns = ["response_id", "model", "doc", "page_num", "natural_text"]
    return responses.where("natural_text is not null").select(*columns).mapInArrow(run, f"{FEATURES}, {COUNTS}")


def _codes(strings: list[str], width: int) -> np.ndarray:
    """The codes of strings of at most ``width`` characters, a row a string."""
    return np.array(strings, f"<U{width}").view(np.uint32).reshape(-1, width).astype(np.uint64)


def _spans(order: int, left: np.ndarray, right: np.ndarray, n: np.ndarray):
    """Contexts that reach back over the beginning of a word: (columns of codes, counts, whether the word ends after it)."""
    reach, long = left.shape[1], np.minimum((right > 0).sum(1), ORDERS[-1])
    for j in range(1, order):
        rows = np.flatnonzero(long >= j)
        at = [left[rows, reach - k] for k in range(order - j, 0, -1)] + [right[rows, k] for k in range(j)]
        yield at, n[rows], long[rows] == j


def _insides(order: int, words: list[str], n: np.ndarray):
    """Contexts within words: (columns of codes, counts, whether the word ends after it)."""
    long = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    first = np.repeat(np.cumsum(long) - long, long)
    place = np.arange(len(codes)) - first + 1
    ends = np.flatnonzero(place >= order)
    yield [codes[ends - k] for k in range(order - 1, -1, -1)], np.repeat(n, long)[ends], place[ends] == np.repeat(long, long)[ends]


def _contexts(pairs: DataFrame) -> DataFrame:
    """``key, l, s, e``: contexts (key: order and fingerprint) and how often they go on with a letter, with a blank, or end.

    A batch's contexts are added up as arrays before they are emitted.
    """
    target = pa.schema([("key", pa.int64()), ("l", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])

    def batch_contexts(a, b, how, n) -> pa.RecordBatch:
        keys, counts = [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)]

        def add(o: int, columns: list[np.ndarray], k: np.ndarray, kinds: np.ndarray) -> None:
            if len(k):
                keys.append((o << BITS) | _buckets(columns, len(k)))
                c = np.zeros((len(k), 3), np.int64)
                c[np.arange(len(k)), kinds] = k
                if kinds[0] == 2:  # an end was counted as an inner pair too: it takes one from the blanks
                    c[:, 1] = -k
                counts.append(c)

        w = how == "w"
        whole = Counter()
        for word, k in zip(b[w].tolist(), n[w].tolist()):
            whole[word] += k
        words, times = list(whole), np.array(list(whole.values()), np.int64)
        e, most = ~w, ORDERS[-1]
        left = _codes([(f" {x} " if x else " ").rjust(most + 1, "\0") for x in a[w]], most + 1)
        right = _codes([x[:most] for x in b[w]], most)
        last = _codes([_pair(x, y)[-most:].rjust(most, "\0") for x, y in zip(a[e], b[e])], most)
        for o, order in enumerate(ORDERS):
            if len(words):
                for columns, k, ended in _spans(order, left, right, n[w]):
                    add(o, columns, k, ended.astype(np.int64))
                for columns, k, ended in _insides(order, words, times):
                    add(o, columns, k, ended.astype(np.int64))
            add(o, [last[:, c] for c in range(most - order, most)], n[e], np.full(len(last), 2))
        key, c = np.concatenate(keys), np.concatenate(counts)
        order_ = np.argsort(key, kind="stable")
        key, c = key[order_], c[order_]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        sums = np.add.reduceat(c, at, axis=0) if len(at) else c
        return pa.RecordBatch.from_arrays([pa.array(key[at]), *[pa.array(np.ascontiguousarray(sums[:, k])) for k in range(3)]], schema=target)

    def run(batches):
        held, rows = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                rows += batch.num_rows
            if held and (batch is None or rows > FLUSH):
                t = pa.Table.from_batches(held)
                col = lambda c: np.array(t[c].to_pylist(), object)
                yield batch_contexts(col("a"), col("b"), col("how"), t["n"].to_numpy())
                held, rows = [], 0

    rows = pairs.select("a", "b", "how", "n").mapInArrow(run, "key bigint, l bigint, s bigint, e bigint")
    return rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in "lse"])


def commonest(counts: DataFrame, kept: int | None = None) -> DataFrame:
    """Of each order the contexts with the most counts, ``kept`` at most: all whose number reaches a level, of four levels a doubling."""
    kept = kept or KEPT
    x = counts.withColumn("o", F.shiftright("key", BITS)).withColumn("level", F.floor(4 * F.log2(F.greatest(F.col("l") + F.col("s") + F.col("e"), F.lit(1)).cast("double"))))
    least = dict.fromkeys(range(len(ORDERS)), 1 << 20)
    room = dict.fromkeys(least, kept)
    for r in sorted(x.groupBy("o", "level").count().collect(), key=lambda r: -r.level):
        room[r.o] = room[r.o] - r["count"]
        if room[r.o] >= 0:
            least[r.o] = r.level
    return x.where(F.array(*[F.lit(least[o]) for o in range(len(ORDERS))])[F.col("o").cast("int")] <= F.col("level")).drop("o", "level")


class Ends:
    """How often contexts end a unit, a word, or neither; the headings that running feet are made of."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, titles=frozenset()):
        self.keys, self.counts, self.titles = keys, counts, titles  # sorted keys; a row a key (letter, blank, end)
        total = counts[: np.searchsorted(keys, 1 << BITS)].sum(0).astype(float) + 1
        self.base = (total / total.sum()).tolist()

    def final(self, feet: pa.ListArray) -> np.ndarray:
        """Where in the flat columns the ending of each text stands: the first whose last line is no running title."""
        at = feet.offsets.to_numpy()
        out, first = at[:-1].copy(), at[0]
        flat = feet.flatten()
        for i in np.flatnonzero(np.diff(at) > 1):
            while (foot := flat[int(out[i] - first)].as_py()) is not None and titled(foot, self.titles):
                out[i] += 1
        return out - first

    def odds(self, contexts: list[str]) -> np.ndarray:
        """Log-odds that a unit ends after each context, and that a word does: a row of two a context."""
        most, n = ORDERS[-1], len(contexts)
        codes = _codes([c[-most:].rjust(most, "\0") for c in contexts], most)
        long = np.array([len(c) for c in contexts], np.int64)
        p, on = np.tile(np.array(self.base), (n, 1)), np.ones(n, bool)
        for o, order in enumerate(ORDERS):
            key = (o << BITS) | _buckets([codes[:, c] for c in range(most - order, most)], n)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on &= ((long >= order) | (o == 0)) & (self.keys[at] == key if len(self.keys) else False)
            c = self.counts[at] if len(self.keys) else np.zeros((n, 3))
            p = np.where(on[:, None], (c + KAPPA * p) / (c.sum(1, keepdims=True) + KAPPA), p)
        p = np.log(p + 1e-9), np.log(p[:, :2].sum(1) + 1e-9), np.log(p[:, 1:].sum(1) + 1e-9)
        return np.stack([p[0][:, 2] - p[1], p[2] - p[0][:, 0]], 1)


def train(passed: DataFrame) -> Ends:
    """The model from the counts of ``read_texts``."""
    pairs = materialise(passed.where("how is not null").groupBy("a", "b", "how").agg(F.sum("n").alias("n")), "p6-counts")
    lines = pairs.where("how = 't'")
    alone = lines.agg(F.sum("n")).first()[0] or 0
    titles = frozenset(r.a for r in lines.where(F.col("n") >= max(4, TITLE_SHARE * alone)).select("a").collect())
    rows = commonest(materialise(_contexts(pairs.where("how <> 't'")), "p6-contexts"))
    got = rows.select("key", *[F.greatest(F.least(c, F.lit(2**31 - 1)), F.lit(0)).cast("int").alias(c) for c in "lse"]).toArrow()  # numbers only, a row a context
    key = got["key"].to_numpy()
    order = np.argsort(key)
    counts = np.empty((len(key), 3), np.int32)
    for k, c in enumerate("lse"):
        counts[:, k] = got[c].to_numpy()[order]
    return Ends(key[order], counts, titles)


_FRONT = re.compile(r"(?:<[^<>]*>|\{\{[^{}]*\}\}|\\\w+\{|[>*_'`\[“„«\s])+")


def _head(text: str) -> str:
    """The first line that is not a running head, without markup before it."""
    at = 0
    while True:
        end = text.find("\n", at)
        line = text[at : end if end >= 0 else len(text)]
        if line.strip() and not ((_DIGITS.search(line) or len(line) < 12) and 0 in furniture(text[at:].split("\n", 4)[:4])):
            m = _FRONT.match(line)
            return line[m.end() :] if m else line
        if end < 0:
            return ""
        at = end + 1


def measure(passed: DataFrame, ends: Ends) -> DataFrame:
    """One small row a response: log-odds at its end and at all complete ends inside (those without a full stop, as the end in
    question is), and what the exact checks compare."""
    shared = passed.sparkSession.sparkContext.broadcast(ends)
    same = ["response_id", "model", "doc", "page", "lang", "length", "n_words", "head_low", "stops"]
    schema = "response_id bigint, model string, doc bigint, page int, lang string, length int, n_words int, head_low boolean, stops array<int>, odds double, word_odds double, inner array<float>, mark boolean, whole boolean, closed boolean, tail bigint, last int"
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        ends = shared.value
        for batch in batches:
            cols = dict(zip([*same, "inner", *_ENDINGS], batch.columns))
            at = pa.array(ends.final(cols["foot"]))
            last = {k: cols[k].flatten().take(at) for k in _ENDINGS if k != "foot"}
            inner, size = cols["inner"], batch.num_rows
            got = ends.odds(last["context"].to_pylist() + inner.flatten().to_pylist())
            yield pa.RecordBatch.from_arrays([
                *[cols[k] for k in same], pa.array(got[:size, 0]), pa.array(got[:size, 1]),
                pa.ListArray.from_arrays(pc.cast(pc.subtract(inner.offsets, inner.offsets[0]), pa.int32()), pa.array(got[size:, 0].astype(np.float32))),
                *[last[k] for k in ("mark", "whole", "closed", "tail", "last")]], schema=target)

    return passed.where("how is null").select(*same, "inner", *_ENDINGS).mapInArrow(run, schema)


def thresholds(rows: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Of each language and run: the low quantile of log-odds at all complete ends inside its texts."""
    sketch = rows.select("lang", "model", F.explode(F.col("inner").cast("array<double>")).alias("inner")).groupBy("lang", "model").agg(F.kll_sketch_agg_double("inner").alias("k"))
    q = F.kll_sketch_get_quantile_double("k", F.lit(quantile))
    return sketch.select("lang", "model", F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), q)).alias("threshold"))


def field_limits(rows: DataFrame, least: int = 5, times: float = 12.0, reach: int = 25) -> DataFrame:
    """``model, length``: lengths at which a run has many times as many texts, with different ends, as at the lengths around, and that few
    texts exceed."""
    n = rows.groupBy("model", "length").agg(F.count("*").alias("n"), F.approx_count_distinct("tail").alias("ends"))
    spread_n = n.select("model", F.col("n").alias("m"), F.explode(F.sequence(F.col("length") - reach, F.col("length") + reach)).alias("length"))
    near = n.join(spread_n, ["model", "length"]).groupBy("model", "length").agg(F.max("n").alias("n"), F.max("ends").alias("ends"), F.sum("m").alias("around"))
    piles = near.where((F.col("ends") > 0.5 * F.col("n")) & (F.col("n") >= least) & (F.col("n") >= times * ((F.col("around") - F.col("n")) / (2 * reach) + 0.05)))
    longer = n.select("model", F.col("length").alias("_l"), F.col("n").alias("_m")).join(piles, "model").where("_l > length").groupBy("model", "length").agg(F.sum("_m").alias("beyond"))
    return piles.join(longer, ["model", "length"], "left").where(F.coalesce("beyond", F.lit(0)) <= F.col("n")).select("model", "length", F.lit(True).alias("at_limit"))


def truncated(rows: DataFrame) -> DataFrame:
    """``response_id, model, lang, is_cut`` of each measured response.

    ``others``: how many other runs hold a text's last words, if it ends with a full stop, once on that page and go on well past them in a
    longer text. A page has as many rows as runs and attempts.
    """
    page = ["doc", "page"]
    at_page, at_tail = Window.partitionBy(*page), Window.partitionBy(*page, "tail")
    x = rows.repartition(*page).withColumn("runs", F.size(F.collect_set("model").over(at_tail))).withColumn("most_runs", F.max("runs").over(at_page)).withColumn("page_words", F.max("n_words").over(at_page))
    x = x.withColumn("beside", F.collect_list(F.struct("model", "n_words", "stops")).over(at_page))
    beyond = F.filter("beside", lambda o: (o["model"] != F.col("model")) & (o["n_words"] >= F.col("n_words") + BEYOND) & F.array_contains(o["stops"], F.col("last")))
    x = x.withColumn("others", F.when(F.col("last").isNotNull(), F.size(F.array_distinct(F.transform(beyond, lambda o: o["model"])))).otherwise(0)).drop("beside", "stops", "inner")
    nexts = rows.select("doc", (F.col("page") - 1).alias("page"), F.col("head_low").cast("int").alias("low")).groupBy(*page).agg((F.avg("low") >= 0.5).alias("goes_on"))
    x = with_group(with_group(x.join(nexts, page, "left"), thresholds(rows), ["lang", "model"]), field_limits(rows), ["model", "length"])
    # Unlikely as an end: after a full stop only where another run goes on; a whole list or table is an end.
    low = (F.col("odds") < F.coalesce("threshold", F.lit(HIGHEST))) & ~F.col("whole") & (~F.col("closed") | (F.col("others") >= 1))
    inside_word = F.col("word_odds") < -2.0
    passed = (F.col("others") >= 2) & (F.col("others") > F.col("runs"))
    shared_end = F.col("runs") >= 2
    only = ~(F.col("most_runs") >= 2) & (F.col("n_words") >= F.col("page_words"))
    runs_over = F.coalesce("goes_on", F.lit(False)) & only & ~inside_word
    at_limit = F.coalesce("at_limit", F.lit(False))
    cut = at_limit | F.col("mark") & (low | inside_word | ~shared_end) | low & ~shared_end & ~runs_over | passed
    return x.select("response_id", "model", "lang", cut.alias("is_cut"), "odds", "threshold", "word_odds", "mark", shared_end.alias("shared_end"), runs_over.alias("runs_over"), at_limit.alias("at_limit"), "closed", "others")


def page_key(path, page, response):
    """A document's number; a response without a path or a page is a document of its own."""
    return F.when(path.isNotNull() & page.isNotNull(), F.xxhash64(path)).otherwise(F.xxhash64(F.lit("no page"), response))


def _measured(spark, sf_dir):
    r = settled_texts(read(spark, sf_dir, "page_responses", "response_id", "model", "source_path", "page_num", "natural_text", "ingested_at"), ["response_id"], "ingested_at")
    r = r.withColumn("doc", page_key(F.col("source_path"), F.col("page_num"), F.col("response_id"))).withColumn("page_num", F.coalesce("page_num", F.lit(-1)))
    passed = materialise(read_texts(r, read(spark, sf_dir, "common_words")), "p6-texts")
    return materialise(measure(passed, train(passed)), "p6-rows")


def p6_found(spark, sf_dir):
    return truncated(_measured(spark, sf_dir)).where("is_cut").select("response_id")


def p6_rates(spark, sf_dir):
    """Of each run: responses with text, cut ones and their rate."""
    t = truncated(_measured(spark, sf_dir))
    return t.groupBy("model").agg(F.count("*").alias("n_texts"), F.sum(F.col("is_cut").cast("bigint")).alias("n_cut"), F.round(F.avg(F.col("is_cut").cast("double")), 6).alias("rate"))
