"""Problem 2: markup residue.

A text is cut into pieces: constructs of HTML, Markdown, wiki and LaTeX, and the runs of text between them. A classifier gives each piece its
log-odds of being markup, which become a terminal capacity; neighbours, pieces of one dialect and the two ends of an element are joined by
smoothness edges. The minimum cut labels the pieces; those on the markup side are taken out or turned into structure, the rest is content.

The classifier is fitted without labels by expectation-maximization on all texts (``learn``). What can be nothing but markup, and what by the
statement of the problem is none (plain bullets, rules), is labelled; all other kinds of construct are told by the company they keep. A kind
that mostly stands in texts with sure markup of its dialect is markup where it stands alone, too; one that mostly stands in plain texts is
content unless sure markup stands around it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict, deque
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import all_texts, count_map, map_rows

#: Tags of HTML and of wiki dialects.
TAGS = set(
    "a abbr address article aside audio b base blockquote body br button caption center cite code col colgroup dd del details div dl dt em "
    "embed fieldset figcaption figure font footer form frame h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li "
    "link main map mark math meta nav nowiki object ol option p param pre q ref references s samp script section select small source span strike "
    "strong style sub summary sup table tbody td textarea tfoot th thead time title tr tt u ul var video gallery noinclude includeonly blink".split()
)

_RUN = r"(?:[^{0}\n]|\n(?!\n))+?"
#: Name, dialect, prior log-odds of being markup, pattern. The order decides where two patterns begin at one place.
_PATTERNS = [
    ("comment", "html", 6.0, r"<!--(?:(?!<!--)[\s\S])*?-->"),
    ("tag", "html", 5.0, r"</?[A-Za-z][A-Za-z0-9]*(?:\s+[\w:-]+\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s<>\"']+))*\s*/?>"),
    ("entity", "html", 4.0, r"&(?:[A-Za-z][A-Za-z0-9]{1,24}|#[0-9]{1,6}|#[xX][0-9A-Fa-f]{1,5});"),
    ("fence", "md", 5.0, r"^(?:```|~~~)[\w-]*[ \t]*$"),
    ("mdhead", "md", 4.0, r"^#{1,6}[ \t]+(?=\S)"),
    ("wikihead", "wiki", 4.5, r"^={2,6}[ \t]*[^=\s][^=\n]*={2,6}[ \t]*$"),
    ("mdrule", "md", 2.5, r"^(?:\|[ \t]*)?:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$"),
    ("wikitable", "wiki", 3.5, r"^(?:\{\|.*|\|\}|\|-+.*|\|\+.*)$"),
    ("wikirow", "wiki", 2.5, r"^[|!][^|\n].*(?:\|\||!!).*$"),
    ("mdrow", "md", 2.0, r"^\|.*\|[ \t]*$"),
    ("quote", "md", 2.2, r"^>[ \t]+(?=\S)"),
    ("image", "md", 5.0, r"!\[[^\]\n]*\]\([^()\n]*\)"),
    ("wikilink", "wiki", 5.0, r"\[\[[^\[\]]+\]\]"),
    ("wikiext", "wiki", 4.0, r"\[(?:https?|ftp)://[^\s\]]+(?: [^\]\n]*)?\]"),
    ("template", "wiki", 5.0, r"\{\{[^{}]+\}\}"),
    ("link", "md", 4.5, r"\[[^\[\]]+\]\([^()\s]+(?:[ \t]+\"[^\"\n]*\")?\)"),
    ("footnote", "md", 4.0, r"\[\^[^\]\s]+\]:?"),
    ("strong", "md", 3.5, r"\*\*(?=[^\s*])" + _RUN.format("*") + r"(?<=[^\s*])\*\*"),
    ("strong2", "md", 3.0, r"(?<!\w)__(?=[^\s_])" + _RUN.format("_") + r"(?<=[^\s_])__(?!\w)"),
    ("em", "md", 2.2, r"(?<![\w*])\*(?=[^\s*])" + _RUN.format("*") + r"(?<=[^\s*])\*(?![\w*])"),
    ("em2", "md", 2.2, r"(?<![\w_])_(?=[^\s_])" + _RUN.format("_") + r"(?<=[^\s_])_(?![\w_])"),
    ("strike", "md", 3.0, r"~~(?=[^\s~])" + _RUN.format("~") + r"(?<=[^\s~])~~"),
    ("tick", "md", 3.0, r"`(?=[^\s`])[^`\n]+`|`(?=[^\s`])" + _RUN.format("`") + r"`"),
    ("quotes", "wiki", 3.0, r"'{2,5}(?=[^\s'])" + _RUN.format("'") + r"(?<=[^\s'])'{2,5}"),
    ("environment", "latex", 5.5, r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?"),
    ("display", "latex", 4.5, r"\$\$[^$]+\$\$|\\\[[\s\S]+?\\\]|\\\([\s\S]+?\\\)"),
    ("inline", "latex", 3.0, r"\$(?=[^\s$\d])[^$\n]*?[\\^_={}][^$\n]*?(?<=[^\s$])\$(?!\d)|\$\d*[A-Za-z]\$(?!\w)"),
    ("command", "latex", 4.0, r"(?<![\w:\\/])\\[A-Za-z]{2,}\*?(?:\[[^\]\n]*\])?\{"),
    ("bare", "latex", 2.5, r"(?<![\w:\\/])\\(?:item|centering|hline|toprule|midrule|bottomrule|maketitle|newline|newpage|clearpage|noindent|par|small|large|bfseries|itshape|ldots|dots|quad|qquad|times|leq|geq|pm|cdot|alpha|beta|gamma|delta|infty|sum|int)\b"),
    ("rowend", "latex", 2.5, r"\\\\[ \t]*$"),
    ("escape", "latex", 0.6, r"(?<!\\)\\[%&_#$](?!\w*\\)"),
    # Beginnings that a cut has left without an end, and signs that need company.
    ("openlink", "wiki", 1.2, r"\[\[(?=[^\[\]\n]*\Z)"),
    ("opentemplate", "wiki", 1.2, r"\{\{(?=[^{}\n]*\Z)"),
    ("opentag", "html", 1.2, r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?\Z"),
    ("openstrong", "md", 0.8, r"\*\*(?=\w[^*]*\Z)"),
    ("rule", "md", -1.0, r"^(?:-{3,}|\*{3,})[ \t]*$"),
    ("item", "md", -2.5, r"^[-*+][ \t]+(?=\S)"),
]
WEIGHTS = {n: w for n, _, w, _ in _PATTERNS}
DIALECT = {n: d for n, d, _, _ in _PATTERNS}
#: Every pattern begins with one of these signs; looking at it first spares the patterns at all other places.
_CONSTRUCT = re.compile(r"(?=[<&`~#=|:!>\[{*_'\\$+-])(?:" + "|".join(f"(?P<{n}>{p})" for n, _, _, p in _PATTERNS) + ")", re.M)
_MAYBE = re.compile(r"(?=[<&`~#=|:!>\[{*_'\\$-])(?:[`\\{*\[$]|<[A-Za-z/!]|&[#A-Za-z]|~~|''|(?<!\w)_\w|__\w|^(?:#|==|[|>!]|---|:-))", re.M)
#: A run of text is content; the longer, the surer.
TEXT_COST = -3.0
#: From these odds on a kind is labelled; a kind with odds between them is learned, from its prior odds, which weigh so much
#: against the texts that have it, at any size.
SURE, PLAIN, WEIGHT = 4.0, -1.0, 1.0
NEAR_CHARS = 40
#: Edge between a construct and the run of text beside it; the least learned edge; the most that one sign of company may say.
BESIDE, LEAST, SIGN = 0.2, 0.1, 1.0
KINDS = {**WEIGHTS, "othertag": 1.0, "baretag": -0.5, "noentity": -1.0}


@dataclass(frozen=True)
class Odds:
    """What the classifier learned: the log-odds of each kind, and the edges to a neighbour, to one's kin and to the other end of an element."""

    kinds: dict[str, float] = field(default_factory=lambda: dict(KINDS))
    near: float = 0.5
    kin: float = 0.6
    pair: float = 1.0


PRIOR = Odds()


def pieces(text: str) -> list[tuple[str, int, int]]:
    """Constructs and the runs of text between them, as (name, start, end); ``text`` names a run."""
    out, at = [], 0
    for m in _CONSTRUCT.finditer(text):
        if m.start() > at:
            out.append(("text", at, m.start()))
        out.append((m.lastgroup, m.start(), m.end()))
        at = m.end()
    if at < len(text):
        out.append(("text", at, len(text)))
    return out


def kind_of(name: str, s: str) -> str:
    """The kind of a construct: its pattern's name, of tags and entities finer."""
    if name == "tag" and re.match(r"</?([A-Za-z0-9]+)", s)[1].lower() not in TAGS:
        return "othertag" if "=" in s or s.startswith("</") else "baretag"
    if name == "entity" and html.unescape(s) == s:
        return "noentity"
    return name


def company(text: str) -> dict[str, tuple[bool, bool]]:
    """Of each kind in a text whether sure markup of its dialect, of another kind, is there too, and whether sure markup stands next to it."""
    at = [(kind_of(n, text[a:b]), DIALECT[n], a, b) for n, a, b in pieces(text) if n != "text"]
    sure = {(d, k) for k, d, _, _ in at if KINDS[k] >= SURE}
    near = {
        x[0] for i, x in enumerate(at) for j in (i - 1, i + 1)
        if 0 <= j < len(at) and KINDS[at[j][0]] >= SURE and (x[2] - at[j][3] if j < i else at[j][2] - x[3]) <= NEAR_CHARS
    }
    return {k: (any(e == d and s != k for e, s in sure), k in near) for k, d, _, _ in at}


def fit(counts: dict[tuple[str, bool, bool], int], rounds: int = 100) -> Odds:
    """Expectation-maximization over (kind, kin, near) counts of texts; a table of some two hundred entries."""
    odds = dict(KINDS)
    n = {k: sum(v for (x, _, _), v in counts.items() if x == k) for k in KINDS}
    signs = [0.0, 0.0], [0.0, 0.0]  # log-odds of kin and near where absent, present
    for _ in range(rounds):
        share = {}
        for (k, kin, near), v in counts.items():
            sure = KINDS[k] >= SURE
            x = 1.0 if sure else 0.0 if KINDS[k] <= PLAIN else 1 / (1 + math.exp(-(odds[k] + signs[0][kin] + signs[1][near])))
            share[k, kin, near] = v * x
        before = [*odds.values(), *signs[0], *signs[1]]
        for k, prior in KINDS.items():
            if PLAIN < prior < SURE:
                m = sum(v for (x, _, _), v in share.items() if x == k)
                p = 1 / (1 + math.exp(-prior))
                w = WEIGHT * (n[k] + 1)
                odds[k] = math.log((m + w * p) / (n[k] - m + w * (1 - p)))
        signs = tuple(
            [math.log(m / c) for m, c in zip(*(
                [sum(w(key) for key in counts if KINDS[key[0]] > PLAIN and key[place] is bool(on)) + a for on, a in ((0, pseudo[0]), (1, pseudo[1]))]
                for w, pseudo in ((lambda key: share[key], (0.5, 0.5)), (lambda key: counts[key] - share[key], (0.95, 0.05)))
            ))] for place in (1, 2)
        )
        whole = [sum(share[k] for k in counts if KINDS[k[0]] > PLAIN) + 1, sum(counts[k] - share[k] for k in counts if KINDS[k[0]] > PLAIN) + 1]
        signs = tuple([max(-SIGN, min(SIGN, x - math.log(whole[0] / whole[1]))) for x in s] for s in signs)
        if max(abs(x - y) for x, y in zip([*odds.values(), *signs[0], *signs[1]], before)) < 1e-6:
            break
    absent = signs[0][0] + signs[1][0]
    kinds = {k: v + absent if PLAIN < KINDS[k] < SURE and n[k] else v for k, v in odds.items()}
    edge = lambda s: max(LEAST, s[1] - s[0])
    return Odds(kinds, edge(signs[1]), edge(signs[0]), edge(signs[0])) if sum(counts.values()) else PRIOR


def learn(texts: DataFrame) -> Odds:
    """The classifier from all texts: counts of kinds by their company are made map-side."""

    def start():
        def work(cols, out: Counter):
            for text in cols[0]:
                if text and _MAYBE.search(text):
                    for kind, (kin, near) in company(text).items():
                        out[kind, kin, near] += 1

        return work

    rows = count_map(texts.where("text is not null"), "kind string, kin boolean, near boolean", ["text"], start).collect()  # kinds times four
    return fit({(r.kind, r.kin, r.near): r.n for r in rows})


def minimum_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """The labelling (True: the positive side) that minimises the wrong side's odds plus the weights of cut edges.

    A node whose odds outweigh all its edges has that label in some minimum; such nodes are fixed first, and again as
    their edges turn into odds of their neighbours. What is left goes through max-flow with shortest augmenting paths.
    """
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        if i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    odds, label = list(odds), [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(odds[i]) >= sum(near[i].values()):
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                odds[j] += w if label[i] else -w
                near[j].pop(i)
                if label[j] is None:
                    queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        s, t = -1, -2
        cap: dict[int, dict[int, float]] = defaultdict(dict)
        for i in rest:
            if odds[i] > 0:
                cap[s][i], cap[i][s] = odds[i], 0.0
            elif odds[i] < 0:
                cap[i][t], cap[t][i] = -odds[i], 0.0
            for j, w in near[i].items():
                cap[i][j] = w
        while True:
            came, q = {s: s}, deque([s])
            while q and t not in came:
                u = q.popleft()
                for v, c in cap[u].items():
                    if c > 1e-9 and v not in came:
                        came[v] = u
                        q.append(v)
            if t not in came:
                break
            path, v = [], t
            while v != s:
                path.append((came[v], v))
                v = came[v]
            f = min(cap[u][v] for u, v in path)
            for u, v in path:
                cap[u][v] -= f
                cap[v][u] = cap[v].get(u, 0.0) + f
        for i in rest:
            label[i] = i in came
    return [bool(x) for x in label]


def label_pieces(text: str, odds: Odds = PRIOR) -> tuple[list[tuple[str, int, int]], list[bool]]:
    """The pieces of a text and whether each is on the markup side of the minimum cut."""
    ps = pieces(text)
    costs = [TEXT_COST - min(3.0, (b - a) / 100) if n == "text" else odds.kinds[kind_of(n, text[a:b])] for n, a, b in ps]
    edges: dict[tuple[int, int], float] = {}
    last: dict[str, int] = {}
    before, opened = None, []

    def join(i: int, j: int, w: float) -> None:
        edges[(i, j)] = edges.get((i, j), 0.0) + w

    for i, (name, a, b) in enumerate(ps):
        if i:  # the run of text beside a construct pulls it a little to its own side
            join(i - 1, i, BESIDE)
        if name == "text":
            continue
        if before is not None and a - ps[before][2] <= NEAR_CHARS:
            join(before, i, odds.near)
        d = DIALECT[name]
        if d in last:
            join(last[d], i, odds.kin)
        if name == "tag":
            tag = re.match(r"</?([A-Za-z0-9]+)", text[a:b])[1].lower()
            if text[a + 1] != "/":
                opened.append((tag, i))
            else:
                for k in range(len(opened) - 1, -1, -1):
                    if opened[k][0] == tag:
                        join(opened[k][1], i, odds.pair)
                        del opened[k:]
                        break
        last[d], before = i, i
    return ps, minimum_cut(costs, edges)


def has_markup(text: str | None, odds: Odds = PRIOR) -> bool:
    """Whether any construct lies on the markup side. Null and empty texts have none."""
    if not text or not _MAYBE.search(text):
        return False
    ps, labels = label_pieces(text, odds)
    return any(x and n != "text" for (n, _, _), x in zip(ps, labels))


# --- clean text ---------------------------------------------------------------------------------------------------

_H, _L, _T, _C, _F, _K, _E = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004", "\ue005", "\ue006"  # marks of structure while cleaning
_INLINE = re.compile(r"^(\*\*|__|~~|'{2,5}|\*|_|`)([\s\S]*)\1$")
_HEADS = {"section", "subsection", "subsubsection", "chapter", "part", "paragraph", "title"}
_DROP = {"label", "ref", "cite", "footnote", "pageref", "eqref", "includegraphics", "documentclass", "usepackage", "author", "date", "bibliography"}
_FORMULA = re.compile(r"^\s*[A-Za-z]\w*\s*=\s*[\d.,]+\s*[A-Za-z]?\S*(?:\s*[-+*/^]\s*\S+)+\s*$")
_CODE = re.compile(r"^\s*(?:if|for|while|def|print|return|import|else)\b.*[:()]|^\s*\w+ = \w+(?:\(.*\)| [-+*/] \w+)\s*$")
_BULLET = re.compile(r"^\s*(?:[•‣◦▪·*+-]|\(?\w{1,3}[.)])\s+(?=\S)")


def _arguments(text: str, at: int) -> int:
    """Where the brace group that begins before ``at`` ends."""
    depth = 1
    while at < len(text) and depth:
        depth += {"{": 1, "}": -1}.get(text[at], 0)
        at += 1
    return at


def _structured(text: str, odds: Odds) -> str:
    ps, labels = label_pieces(text, odds)
    out, skip_to, table = [], 0, False
    for (name, a, b), markup in zip(ps, labels):
        if b <= skip_to:
            continue
        s = text[max(a, skip_to) : b]
        if not markup or name == "text":
            out.append(s)
        elif name == "tag":
            tag = re.match(r"</?([A-Za-z0-9]+)", s)[1].lower()
            close = s[1] == "/"
            if tag == "ref" and not close and not s.endswith("/>"):
                end = text.find("</ref>", b)
                skip_to = end + 6 if end >= 0 else b
            elif tag in ("script", "style") and not close:
                end = text.lower().find(f"</{tag}>", b)
                skip_to = end + len(tag) + 3 if end >= 0 else b
            elif tag == "math":
                out.append(_E if close else _F)
            elif tag in ("pre", "code", "nowiki", "tt", "kbd", "samp"):
                out.append(_E if close else _K)
            elif tag in ("h1", "h2", "h3", "h4", "h5", "h6", "title"):
                out.append("\n" if close else "\n" + _H)
            elif tag == "li":
                out.append("\n" if close else "\n" + _L)
            elif tag == "tr":
                out.append("\n" if close else "\n" + _T)
            elif tag in ("td", "th"):
                out.append(_C if close else "")
            elif tag in ("sup", "sub"):
                out.append("" if close else "^" if tag == "sup" else "_")
            elif tag in ("p", "div", "br", "table", "ul", "ol", "blockquote", "section", "article", "hr", "caption", "dl", "dt", "dd"):
                out.append("\n")
        elif name == "entity":
            out.append(html.unescape(s).replace("\xa0", " "))
        elif name == "mdhead":
            out.append(_H)
        elif name == "wikihead":
            out.append(_H + s.strip().strip("=").strip())
        elif name in ("mdrow", "wikirow"):
            cells = re.split(r"\|\||!!|\|", s.strip().strip("|!"))
            out.append(_T + _C.join(c.strip() for c in cells) + _C)
        elif name == "fence":
            out.append("\ue007")
        elif name == "wikilink":
            out.append(s[2:-2].split("|")[-1])
        elif name == "wikiext":
            out.append(s[1:-1].partition(" ")[2])
        elif name == "link":
            out.append(re.match(r"\[([^\[\]]+)\]", s)[1])
        elif name in ("strong", "strong2", "em", "em2", "strike", "tick", "quotes"):
            m = _INLINE.match(s)
            out.append((_K + m[2] + _E if name == "tick" else m[2]) if m else s)
        elif name in ("display", "inline"):
            out.append(_F + s.strip("$").removeprefix("\\[").removesuffix("\\]").removeprefix("\\(").removesuffix("\\)").strip() + _E)
        elif name == "environment":
            env = re.search(r"\{([A-Za-z]+)", s)[1]
            if env in ("tabular", "tabularx", "longtable"):
                table = "begin" in s
            out.append(("\ue007" if env in ("verbatim", "lstlisting") else _F if "begin" in s and env in ("equation", "align") else _E if env in ("equation", "align") else "\n"))
        elif name == "command":
            word = re.match(r"\\([A-Za-z]+)", s)[1]
            end = _arguments(text, b)
            inner = text[b : end - 1] if text[end - 1 : end] == "}" else text[b:end]
            if word not in _DROP:
                out.append(("\n" + _H if word in _HEADS else "") + _plain(inner) + ("\n" if word in _HEADS else ""))
            skip_to = end
        elif name == "bare":
            out.append(_L if s == "\\item" else "" if s in ("\\centering", "\\hline", "\\maketitle", "\\noindent") else s if s in ("\\times", "\\leq", "\\geq", "\\pm", "\\cdot") else " ")
        elif name == "rowend":
            out.append(_C if table else "\n")
        elif name == "escape":
            out.append(s[1:])
        # comments, images, templates, footnotes, rules, quote signs and wiki table frames leave nothing
    done = "".join(out)
    if table or "\\begin{tabular" in text:
        done = re.sub(r"^([^\n\ue000-\ue007]* & [^\n]*?)\ue003?$", lambda m: _T + m[1].replace(" & ", _C) + _C, done, flags=re.M)
    return done


def _plain(s: str) -> str:
    return re.sub(r"\\[A-Za-z]+\*?\{([^{}]*)\}", r"\1", s)


def clean_blocks(text: str | None, odds: Odds = PRIOR) -> list[tuple[str, str]] | None:
    """The clean text as (kind, text) blocks: heading, paragraph, list, table, code or formula.

    A list or table row is one block, cells are parted by tabs. Null stays null, an empty text has no blocks.
    """
    if text is None:
        return None
    out: list[tuple[str, str]] = []
    code = False
    para: list[str] = []

    def flush():
        if para:
            out.append(("paragraph", re.sub(r"[ \t]+", " ", "\n".join(para)).strip()))
            para.clear()

    for line in (_structured(text, odds) if _MAYBE.search(text) else text).split("\n"):
        if "\ue007" in line:
            flush()
            code = not code
            continue
        bare = re.sub("[\ue000-\ue007]", "", line)
        if code:
            out.append(("code", bare))
        elif not bare.strip():
            flush()
        elif _K in line and not line.replace(_K, "\0").split("\0")[0].strip() and _E not in line:
            flush()
            code = True
            out.append(("code", bare))
        elif line.lstrip().startswith(_H):
            flush()
            out.append(("heading", bare.strip()))
        elif line.lstrip().startswith(_T) or "\t" in line:
            flush()
            out.append(("table", "\t".join(c.strip() for c in re.sub("[\ue000-\ue002\ue004-\ue007]", "", line).rstrip(_C).replace(_C, "\t").split("\t"))))
        elif line.lstrip().startswith(_L) or _BULLET.match(bare):
            flush()
            out.append(("list", _BULLET.sub("", bare).strip() if not line.lstrip().startswith(_L) else bare.strip()))
        elif _F in line and not re.sub(f"{_F}[^{_E}]*{_E}?", "", line).strip(" .,") or _FORMULA.match(bare):
            flush()
            out.append(("formula", bare.strip()))
        elif _CODE.match(bare):
            flush()
            out.append(("code", bare))
        elif len(re.findall(r" {2,}(?=\S)| \| ", bare.strip())) >= 2:
            flush()
            out.append(("table", re.sub(r" {2,}| \| ", "\t", bare.strip())))
        else:
            para.append(bare.replace("\xad\n", "").strip())
        if code and _E in line:
            code = False
    flush()
    return [(k, t) for k, t in out if t.strip()]


# --- operators ----------------------------------------------------------------------------------------------------


def markup_flags(texts: DataFrame, odds: Odds = PRIOR) -> DataFrame:
    """``tbl, record_id, is_case`` of each non-null text."""

    def start():
        def work(cols):
            keep = [i for i, t in enumerate(cols[2]) if t is not None]
            return {"tbl": [cols[0][i] for i in keep], "record_id": [cols[1][i] for i in keep], "is_case": [has_markup(cols[2][i], odds) for i in keep]}

        return work

    return map_rows(texts, "tbl string, record_id bigint, is_case boolean", ["tbl", "record_id", "text"], start)


def clean_texts(texts: DataFrame, odds: Odds = PRIOR) -> DataFrame:
    """``tbl, record_id, clean_text, blocks`` of each text; ``blocks`` tells headings, lists, tables, code and formulas apart."""

    def start():
        def work(cols):
            blocks = [clean_blocks(t, odds) for t in cols[2]]
            return {"tbl": cols[0], "record_id": cols[1],
                    "clean_text": [None if b is None else "\n".join(t for _, t in b) for b in blocks],
                    "blocks": [None if b is None else [{"kind": k, "text": t} for k, t in b] for b in blocks]}

        return work

    schema = "tbl string, record_id bigint, clean_text string, blocks array<struct<kind:string,text:string>>"
    return map_rows(texts, schema, ["tbl", "record_id", "text"], start)


def p2_found(spark, sf_dir):
    texts = all_texts(spark, sf_dir)
    return markup_flags(texts, learn(texts)).where("is_case").select("tbl", "record_id")


def p2_clean(spark, sf_dir):
    """Clean text and number of blocks of each kind, for every record."""
    texts = all_texts(spark, sf_dir)
    c = clean_texts(texts, learn(texts))
    n = lambda k: F.size(F.filter("blocks", lambda b: b["kind"] == k)).alias(f"n_{k}")
    return c.select("tbl", "record_id", "clean_text", *[n(k) for k in ("heading", "paragraph", "list", "table", "code", "formula")])
