"""Parsers of model answers: column expressions, and one Arrow function for layout HTML.

Each gives ``struct<primary_language, is_rotation_valid, rotation_correction, is_table, is_diagram, natural_text, error>``.
"""

from __future__ import annotations

import json
import re
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE, strip

#: The columns of an answer; patterns of code fences, picture boxes and enumerators; tags without an end.
RESPONSE = "primary_language string, is_rotation_valid boolean, rotation_correction int, is_table boolean, is_diagram boolean, natural_text string, error string"
_FENCE = rf"(?is)^[{SPACE}]*```(?:markdown|md)?[ \t]*\n(.*?)\n```[{SPACE}]*$"
_BBOX = r'<img\s+src="images/bbox_\d+_\d+_\d+_\d+\.jpg"\s*/?>'


def strip_fence(raw: Column) -> Column:
    """Without one code fence around the whole answer."""
    return F.when(raw.rlike(_FENCE), F.regexp_extract(raw, _FENCE, 1)).otherwise(raw)


def strip_think(raw: Column) -> Column:
    """Without complete reasoning blocks; a lone closing mark is text."""
    return F.regexp_replace(raw, r"(?s)<think>.*?</think>", "")


def has_html_table(text: Column) -> Column:
    return F.coalesce(F.lower(text).contains("<table"), F.lit(False))


def _response(text: Column, is_table: Column | None = None, is_diagram: Column | None = None) -> Column:
    no = F.lit(False)
    return F.struct(
        F.lit(None).cast("string").alias("primary_language"), F.lit(True).alias("is_rotation_valid"), F.lit(0).alias("rotation_correction"),
        (no if is_table is None else is_table).alias("is_table"), (no if is_diagram is None else is_diagram).alias("is_diagram"),
        text.alias("natural_text"), F.lit(None).cast("string").alias("error"))


def _text(raw: Column) -> Column:
    t = strip(strip_fence(raw))
    return F.when(t != "", t)


def markdown(raw: Column) -> Column:
    """The answer is the page's Markdown."""
    return _response(_text(raw))


def with_html_tables(raw: Column) -> Column:
    """Markdown with HTML tables, perhaps after reasoning."""
    t = _text(strip_think(raw))
    return _response(t, has_html_table(t))


def bbox_images(raw: Column) -> Column:
    """Markdown with placeholders for pictures, which are dropped and flag a diagram."""
    r = strip_think(raw)
    t = _text(F.regexp_replace(F.regexp_replace(r, _BBOX, ""), r"\n{3,}", "\n\n"))
    return _response(t, has_html_table(t), r.rlike(_BBOX))


def grounding(raw: Column) -> Column:
    """Markdown with grounding marks: texts are kept, boxes and other marks dropped."""
    t = F.regexp_replace(raw, r"(?s)<\|ref\|>(.*?)<\|/ref\|>", "$1")
    t = F.regexp_replace(t, r"(?s)<\|det\|>.*?<\|/det\|>", "")
    return _response(_text(F.regexp_replace(t, r"<[|｜][^<>]*?[|｜]>", "")))


_FIELDS = {"primary_language": "string", "is_rotation_valid": "boolean", "rotation_correction": "int", "is_table": "boolean", "is_diagram": "boolean"}


def front_matter(raw: Column) -> Column:
    """A flat YAML preamble and Markdown. A missing, surplus or malformed field sets ``error`` and the fields stay null.

    YAML's words for true and false in the language's place mean that there is none, as do ``null``, ``~`` and nothing.
    """
    head = r"(?s)^---\n(.*?)\n?---"
    has = raw.startswith("---\n") & (F.locate("\n---", F.substring(raw, 4, 2**30)) > 0)
    end = F.locate("\n---", raw, 4)
    block = F.when(has, F.substring(raw, F.lit(5), F.greatest(end - 5, F.lit(0))))
    body = strip(F.when(has, F.substring(raw, end + 4, F.length(raw))).otherwise(raw))
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\n"), lambda x: strip(x) != "")
    keys = F.transform(lines, lambda x: strip(F.split_part(x, F.lit(":"), F.lit(1))))
    value = lambda k: F.regexp_replace(strip(F.regexp_extract(block, rf"(?m)^\s*{k}\s*:(.*)$", 1)), "^([\"'])(.*)\\1$", "$2")
    low = lambda k: F.lower(value(k))
    true, false, none = ["true", "yes", "on"], ["false", "no", "off"], ["null", "~", ""]
    as_bool = lambda k: F.when(low(k).isin(true), F.lit(True)).when(low(k).isin(false), F.lit(False))
    language = F.when(~low("primary_language").isin(*true, *false, *none), value("primary_language"))
    turned = value("rotation_correction").try_cast("int")
    missing = F.array_except(F.array(*[F.lit(k) for k in _FIELDS]), keys)
    surplus = F.array_except(keys, F.array(*[F.lit(k) for k in _FIELDS]))
    error = (
        F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
        .when(F.size(surplus) > 0, F.concat(F.lit("unexpected "), F.array_join(surplus, ",")))
        .when(~F.coalesce(turned.isin(0, 90, 180, 270), F.lit(False)), F.lit("rotation_correction"))
        .when(as_bool("is_rotation_valid").isNull() | as_bool("is_table").isNull() | as_bool("is_diagram").isNull(), F.lit("flag")))
    ok = error.isNull()
    return F.struct(
        F.when(ok, language).alias("primary_language"), F.when(ok, as_bool("is_rotation_valid")).alias("is_rotation_valid"), F.when(ok, turned).alias("rotation_correction"),
        F.when(ok, as_bool("is_table")).alias("is_table"), F.when(ok, as_bool("is_diagram")).alias("is_diagram"), F.when(body != "", body).alias("natural_text"), error.alias("error"))


_ENUMERATED = re.compile(r"\(?(?:\d{1,3}|[A-Za-z]|[ivxlcdm]{1,4})[.)]\s")
#: Columns that one cell may span.
WIDEST = 1000


class _Layout(HTMLParser):
    """Turns labelled layout HTML into Markdown with an explicit stack, so nesting of any depth is safe."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.frames: list[dict] = []  # open elements that gather their own text
        self.lists: list[list] = []

    def _write(self, s: str):
        (self.frames[-1]["parts"] if self.frames else self.out).append(s)

    def _open(self, tag: str, **kw):
        self.frames.append({"tag": tag, "parts": [], **kw})

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "div" and (a.get("data-label") or "").strip() in ("Section-Header", "Title"):
            self._open(tag, heading=True)
        elif tag in ("div", "p", "li", "math", "td", "th", "table", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "b", "strong", "i", "em", "code", "blockquote", "pre", "a"):
            self._open(tag, block=(a.get("display") or "").lower() == "block", href=a.get("href"), title=a.get("title"), span=a.get("colspan") or "1")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self._write("\n")
        elif tag == "br":
            self._write("\n")
        elif tag == "img":
            self._write(f"![{a.get('alt') or ''}]({a.get('src') or ''})")

    def handle_endtag(self, tag):
        if tag in ("ul", "ol"):
            if self.lists:
                self.lists.pop()
            self._write("\n")
        elif any(f["tag"] == tag for f in self.frames):
            while True:
                f = self.frames.pop()
                self._close(f)
                if f["tag"] == tag:
                    break

    def _close(self, f: dict):
        tag, text = f["tag"], "".join(f["parts"])
        s = text.strip()
        if f.get("heading") or tag[0] == "h" and tag[1:].isdigit():
            level = 1 if f.get("heading") else int(tag[1])
            s = " ".join(re.sub(r"[*_]{1,2}(?=\S)|(?<=\S)[*_]{1,2}", "", s).split()) if f.get("heading") else s
            self._write(f"\n{'#' * level} {s}\n\n" if s else "")
        elif tag in ("div", "p"):
            self._write(f"{s}\n\n" if s else "")
        elif tag == "blockquote":
            quoted = "\n".join(f"> {x}".rstrip() for x in s.split("\n"))
            self._write(f"\n{quoted}\n\n" if s else "")
        elif tag == "pre":
            inner = text.strip("\n").removeprefix("`").removesuffix("`") if s.startswith("`") else text.strip("\n")
            self._write(f"\n```\n{inner}\n```\n\n" if s else "")
        elif tag == "a":
            title = ' "{}"'.format(f["title"].replace('"', r"\"")) if f["title"] else ""
            self._write("" if not s else s if not f["href"] else f"<{s}>" if s == f["href"] and not title else f"[{s}]({f['href']}{title})")
        elif tag == "li":
            if self.lists:
                self.lists[-1][1] += 1
            mark = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "* "
            self._write(f"{s}\n" if _ENUMERATED.match(s) else f"{mark}{s}\n")
        elif tag == "math":
            self._write("" if not s else f"\\[ {s} \\]" if f["block"] else f"\\( {s} \\)")
        elif tag in ("b", "strong", "i", "em", "code"):
            m = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}[tag]
            self._write(f"{m}{s}{m}" if s else "")
        elif tag in ("td", "th"):
            row = next((x for x in reversed(self.frames) if x["tag"] == "tr"), None)
            cell = " ".join(s.split()).replace("|", "\\|")
            if row is None:
                self._write(f"{cell} ")
            else:
                width = int(f["span"]) if f["span"].isdigit() else 1
                row.setdefault("cells", []).extend([cell, *[""] * (min(max(width, 1), WIDEST) - 1)])
        elif tag == "tr":
            table = next((x for x in reversed(self.frames) if x["tag"] == "table"), None)
            if table is None:
                self._write(" | ".join(f.get("cells", [])) + "\n")
            else:
                table.setdefault("rows", []).append(f.get("cells", []))
        elif tag == "table":
            rows = f.get("rows", [])
            width = max(map(len, rows), default=0)
            lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
            if lines:
                lines.insert(1, "|" + " --- |" * width)
            self._write("\n" + "\n".join(lines) + "\n\n" if lines else "")

    def handle_data(self, data):
        self._write(data if self.frames and self.frames[-1]["tag"] in ("math", "code", "pre") else re.sub(r"\s+", " ", data))

    def finish(self) -> str:
        self.close()
        while self.frames:
            self._close(self.frames.pop())
        return "".join(self.out)


def layout_to_markdown(html: str) -> str:
    """Markdown of labelled layout HTML; if it cannot be parsed, its text without tags."""
    try:
        p = _Layout()
        p.feed(html)
        text = p.finish()
    except Exception:
        text = unescape(re.sub(r"<[^>]+>", " ", html))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()


@F.pandas_udf(T.StringType())
def _layout(raw: pd.Series) -> pd.Series:
    return raw.map(layout_to_markdown, na_action="ignore")


def layout_html(raw: Column) -> Column:
    """Labelled layout HTML; labels flag tables and diagrams."""
    t = _layout(raw)
    return _response(F.when(t != "", t), raw.rlike(r"""data-label\s*=\s*["']Table["']"""), raw.rlike(r"""data-label\s*=\s*["'](?:Figure|Image|Diagram)["']"""))


#: Adapters by name: parser, longest image side, sampling settings (JSON), guided regex; the tokens of an answer.
ADAPTERS = {
    "markdown": (markdown, 1288, "{}", None),
    "olmocr": (front_matter, 1288, "{}", r"---\nprimary_language: (?:[a-z]{2}|null)\nis_rotation_valid: (?:True|False|true|false)\nrotation_correction: (?:0|90|180|270)\nis_table: (?:True|False|true|false)\nis_diagram: (?:True|False|true|false)\n(?:---|---\n[\s\S]+)"),
    "lightonocr2": (markdown, 1540, '{"top_p": 0.9}', None),
    "lightonocr2-soup": (markdown, 1540, '{"top_p": 0.9}', None),
    "glm-ocr": (markdown, 1288, "{}", None),
    "qianfan-ocr": (with_html_tables, 1540, '{"top_p": 1.0, "max_tokens": 12000}', None),
    "infinity-parser2-flash": (with_html_tables, 1540, '{"top_p": 1.0, "chat_template_kwargs": {"enable_thinking": false}}', None),
    "surya2": (layout_html, 1540, "{}", None),
    "unlimited-ocr": (grounding, 1024, '{"skip_special_tokens": false, "vllm_xargs": {"ngram_size": 35, "window_size": 128}}', None),
    "ovisocr2": (bbox_images, 1540, '{"max_tokens": 16384}', None),
}


ANSWER_TOKENS = 8000


def render_size(name: str, explicit: int | None = None) -> int:
    """The longest side of a page's picture: what is asked for, else what the adapter prefers."""
    parser(name)
    return ADAPTERS[name][1] if explicit is None else explicit


def page_request(image: Column, prompt: Column, temperature: Column, name: str, served: str) -> Column:
    """The request for a page as JSON: the prompt and the picture (base64 PNG), the bound of an answer, the attempt's temperature; the adapter's own
    settings stand in place of the general ones."""
    parser(name)
    own = json.loads(ADAPTERS[name][2])
    url = F.struct(F.concat(F.lit("data:image/png;base64,"), image).alias("url"))
    content = F.array(F.to_json(F.struct(F.lit("text").alias("type"), prompt.alias("text"))), F.to_json(F.struct(F.lit("image_url").alias("type"), url.alias("image_url"))))
    messages = F.concat(F.lit('[{"role":"user","content":['), F.array_join(content, ","), F.lit("]}]"))
    general = {"model": F.lit(json.dumps(served)), "messages": messages, "max_tokens": F.lit(str(ANSWER_TOKENS)), "temperature": temperature.cast("string")}
    fields = general | {k: F.lit(json.dumps(v)) for k, v in own.items()}
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f"{json.dumps(k)}:"), v) for k, v in fields.items()]), F.lit("}"))


def parser(name: str):
    """The column function of an adapter; an unknown name lists the choices."""
    if name not in ADAPTERS:
        raise ValueError(f"unknown adapter {name!r}; choose from: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name][0]


def adapters(spark):
    """The registry as a small table."""
    return spark.createDataFrame([(k, v[1], v[2], v[3]) for k, v in ADAPTERS.items()], "name string, longest_side int, sampling string, guided_regex string")
