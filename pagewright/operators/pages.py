"""Attempts to pages, pages to documents, documents to pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsers, quality
from ..functions.text import strip

#: The temperature of each attempt, the last for all further ones; how many attempts a page has.
TEMPERATURES, MAX_ATTEMPTS = (0.1, 0.1, 0.2, 0.3, 0.5, 0.8, 0.9, 1.0), 8


def temperature(attempt: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in TEMPERATURES]), F.least(attempt + 1, F.lit(len(TEMPERATURES))))


def evaluate_attempts(attempts: DataFrame, adapter: str = "markdown", disabled=()) -> DataFrame:
    """Adds the parsed answer, its ``kind`` and the verdict ``is_valid``, ``is_terminal``, ``is_blank``.

    An answer with another status than 200, or that the adapter cannot parse, is failed: neither valid nor terminal, kind 'failed'. On a nearly
    blank render an empty or looping answer is accepted with a null text.
    """
    a = attempts.withColumn("_p", parsers.parser(adapter)(F.col("raw")))
    failed = (F.col("status") != 200) | F.col("raw").isNull() | F.col("_p.error").isNotNull()
    a = a.withColumn("_t", strip(F.coalesce(F.col("_p.natural_text"), F.lit(""))))
    a = a.withColumn("kind", F.when(failed, F.lit("failed")).otherwise(quality.verdict(F.col("_t"), disabled)))
    a = a.withColumn("is_blank", quality.is_blank_page(F.col("kind"), F.col("ink")))
    fields = [F.col(f"_p.{c}").alias(c) for c in ("primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram")]
    return a.select(*attempts.columns, *fields, F.when(~F.col("is_blank"), F.col("_p.natural_text")).alias("natural_text"), "kind", "is_blank",
                    ((F.col("kind") == "ok") | F.col("is_blank")).alias("is_valid"), ((F.col("kind") == "refusal")).alias("is_terminal"))


def select_attempts(attempts: DataFrame, keys: list[str], max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``keys, attempt, is_fallback, n_attempts``: the first valid attempt before any terminal one, else none (a fallback)."""
    a = attempts.where(F.col("attempt") < max_attempts)
    first = lambda c: F.min(F.when(F.col(c), F.col("attempt")))
    g = a.groupBy(*keys).agg(first("is_valid").alias("_v"), first("is_terminal").alias("_t"), F.count("*").alias("n_attempts"))
    ok = F.col("_v").isNotNull() & (F.col("_t").isNull() | (F.col("_v") < F.col("_t")))
    return g.select(*keys, F.when(ok, F.col("_v")).alias("attempt"), (~ok).alias("is_fallback"), "n_attempts")


def selected_pages(attempts: DataFrame, keys: list[str], fallback: DataFrame | None = None, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One row a page: the chosen attempt's row, or the text layer with no tokens. ``fallback``: ``doc, page, layer``."""
    chosen = select_attempts(attempts, keys, max_attempts)
    out = chosen.join(attempts, [*keys, "attempt"], "left")
    text = F.col("natural_text")
    if fallback is not None:
        out = out.join(fallback, ["doc", "page"], "left")
        text = F.when(F.col("is_fallback"), F.col("layer")).otherwise(text)
    zero = lambda c: F.when(F.col("is_fallback"), F.lit(0)).otherwise(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c)
    flag = lambda c, d: F.coalesce(F.col(c), F.lit(d)).alias(c)
    return out.select(*keys, "attempt", "is_fallback", "n_attempts", text.alias("natural_text"), zero("input_tokens"), zero("output_tokens"), "primary_language",
                      flag("is_rotation_valid", True), flag("rotation_correction", 0), flag("is_table", False), flag("is_diagram", False))


def classify_document(pages: Column, fallback: Column, max_rate: float) -> Column:
    """'ok', 'partial' or 'discarded' by the share of fallback pages; no pages at all are discarded."""
    return F.when(pages <= 0, "discarded").when(fallback.cast("double") / pages > max_rate, "discarded").when(fallback > 0, "partial").otherwise("ok")


def assemble(pages: DataFrame, keys: list[str], version: str, added: Column | None = None, max_rate: float | None = None) -> DataFrame:
    """Documents from pages in page order: text, spans of each page in code points, sums and flags.

    Every page with a text but the last one gets a line end. A document without any text gives no row, nor does one over ``max_rate``; ``outcome`` tells
    the others apart. A page's rows must be one.
    """
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("page").desc())) == 1
    content = F.when(F.col("natural_text").isNull(), "").otherwise(F.concat("natural_text", F.when(last, "").otherwise("\n")))
    before = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    p = pages.withColumn("_c", content).withColumn("_n", F.length("_c").cast("bigint")).withColumn("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    row = F.struct("page", F.col("_c").alias("c"), F.col("_at").alias("a"), (F.col("_at") + F.col("_n")).alias("z"), "primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram")
    d = p.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_p"), F.count("*").alias("_pages"), F.sum("input_tokens").alias("_in"), F.sum("output_tokens").alias("_out"),
                             F.sum(F.col("is_fallback").cast("bigint")).alias("_fb"))
    d = d.withColumn("text", F.array_join(F.transform("_p", lambda x: x["c"]), ""))
    rate = 1.0 if max_rate is None else max_rate
    d = d.withColumn("outcome", classify_document(F.col("_pages"), F.col("_fb"), rate)).where((F.col("text") != "") & (F.col("outcome") != "discarded"))
    day = added if added is not None else F.date_format(F.current_date(), "yyyy-MM-dd")
    each = lambda c: F.transform("_p", lambda x: x[c]).alias(c)
    spans = F.transform("_p", lambda x: F.array(x["a"], x["z"], x["page"].cast("bigint"))).alias("pdf_page_numbers")
    meta = F.struct(F.col("doc").alias("Source-File"), F.lit(version).alias("pagewright-version"), F.col("_pages").alias("pdf-total-pages"), F.col("_in").alias("total-input-tokens"),
                    F.col("_out").alias("total-output-tokens"), F.col("_fb").alias("total-fallback-pages"))
    attributes = F.struct(spans, *[each(c) for c in ("primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram")])
    return d.select(*keys, F.sha1(F.encode("text", "UTF-8")).alias("id"), "text", F.lit("pagewright").alias("source"), day.alias("added"), day.alias("created"), "outcome",
                    meta.alias("metadata"), attributes.alias("attributes"))


#: Code points of the pieces into which a text is cut, in this order, before pages are cut from the last ones. A string's two GB have eight of the first.
PIECES = (1 << 28, 1 << 24, 1 << 20, 1 << 16, 1 << 12)


def _pieces(text: Column) -> Column:
    """The text in pieces of ``PIECES[-1]`` code points. Finding a place in UTF-8 reads all that is before it, so each step cuts only pieces of the last;
    what has no more bytes than a piece may have code points stays whole."""
    parts = F.when(text.isNotNull(), F.array(text))
    for size in PIECES:
        cut = lambda t: F.transform(F.sequence(F.lit(0), F.length(t) - 1, F.lit(size)), lambda i: F.substring(t, i + 1, F.lit(size)))  # noqa: B023, E731
        parts = F.flatten(F.transform(parts, lambda t: F.when(F.octet_length(t) <= size, F.array(t)).otherwise(cut(t))))  # noqa: B023
    return parts


def explode_pages(documents: DataFrame, model: Column) -> DataFrame:
    """``model, doc, page, text``: the slice of each span that is not empty. Offsets count code points. Time grows with the text, not with text times pages."""
    size = PIECES[-1]

    def page(pieces: Column, s: Column) -> Column:
        first, last = (F.greatest(F.floor(x / size).cast("int"), F.lit(0)) for x in (s[0], s[1] - 1))
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.struct(s[2].cast("int").alias("page"), F.substring(near, (s[0] - first * size + 1).cast("int"), (s[1] - s[0]).cast("int")).alias("text"))

    spans = F.filter("attributes.pdf_page_numbers", lambda s: s[1] > s[0])
    pages = F.flatten(F.transform(F.array(_pieces(F.col("text"))), lambda p: F.transform(spans, lambda s: page(p, s))))  # an argument is evaluated once, what a lambda names for each span
    return documents.select(model.alias("model"), F.col("metadata.Source-File").alias("doc"), F.explode(pages).alias("p")).select("model", "doc", "p.page", "p.text")


def document_meta(documents: DataFrame, model: Column) -> DataFrame:
    m = F.col("metadata")
    return documents.select(model.alias("model"), m["Source-File"].alias("doc"), F.coalesce(m["pdf-total-pages"], F.size("attributes.pdf_page_numbers").cast("bigint")).alias("total_pages"),
                            F.coalesce(m["total-fallback-pages"], F.lit(0)).alias("fallback_pages"), m["Source-File"].alias("source_file"))


def require_unique(documents: DataFrame) -> DataFrame:
    """The documents; an error if one run names a source file twice. Names are counted before, without the texts."""
    twice = documents.groupBy("model", F.col("metadata.Source-File").alias("doc")).count().where("count > 1").orderBy("model", "doc").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate Source-File {twice[0].doc!r} in run {twice[0].model!r}")
    return documents


def document_checksums(pages: DataFrame) -> DataFrame:
    """``model, doc, text_sha1`` over the pages in order of page and text."""
    part = F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: F.concat(x["page"].cast("string"), F.lit("\0"), x["text"], F.lit("\0")))
    return pages.groupBy("model", "doc").agg(F.sha1(F.encode(F.array_join(part, ""), "UTF-8")).alias("text_sha1"))


def outcome_counts(pages: DataFrame, keys: list[str], max_rate: float, expected: DataFrame | None = None, crashed: DataFrame | None = None) -> DataFrame:
    """``outcome, n`` over documents. Of the ``expected`` ones (``keys``) those without pages are 'crashed' if they are in ``crashed``, else 'missing';
    a crashed document with pages counts as crashed once."""
    d = pages.groupBy(*keys).agg(F.count("*").alias("p"), F.sum(F.col("is_fallback").cast("bigint")).alias("f"))
    d = d.select(*keys, classify_document(F.col("p"), F.col("f"), max_rate).alias("outcome"))
    if expected is not None:
        d = d.join(expected.select(*keys).distinct(), keys, "full")
    if crashed is not None:
        d = d.join(crashed.select(*keys).distinct().withColumn("_c", F.lit(True)), keys, "full").withColumn("outcome", F.when(F.col("_c"), F.lit("crashed")).otherwise(F.col("outcome")))
    return d.groupBy(F.coalesce("outcome", F.lit("missing")).alias("outcome")).agg(F.count("*").alias("n"))
