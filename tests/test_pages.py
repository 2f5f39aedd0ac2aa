import hashlib
import time

import pytest
from pyspark.sql import functions as F

from pagewright.operators import pages as pg

FIELDS = "doc string, page int, natural_text string, input_tokens bigint, output_tokens bigint, is_fallback boolean, primary_language string, is_rotation_valid boolean, rotation_correction int, is_table boolean, is_diagram boolean"


def page(doc, n, text, fallback=False):
    return (doc, n, text, 10, 5, fallback, "en", True, 0, False, False)


def test_assembly_round_trip(spark):
    rows = [page("a", 1, "alphé 😀"), page("a", 2, None), page("a", 3, "gamma"), page("b", 1, None), page("c", 1, "x"), page("c", 2, ""), page("d", 1, "y"), page("d", 2, None)]
    docs = pg.assemble(spark.createDataFrame(rows, FIELDS), ["doc"], "v", F.lit("2025-01-01")).cache()
    by = {r.doc: r for r in docs.collect()}
    assert set(by) == {"a", "c", "d"} and by["a"].text == "alphé 😀\ngamma" and by["a"].id == hashlib.sha1("alphé 😀\ngamma".encode()).hexdigest()
    assert by["a"].attributes.pdf_page_numbers == [[0, 8, 1], [8, 8, 2], [8, 13, 3]] and by["a"].metadata["pdf-total-pages"] == 3 and by["d"].text == "y\n"
    got = {(r.doc, r.page): r.text for r in pg.explode_pages(docs, F.lit("m")).collect()}
    assert got == {("a", 1): "alphé 😀\n", ("a", 3): "gamma", ("c", 1): "x\n", ("d", 1): "y\n"}
    m = {r.doc: r for r in pg.document_meta(docs, F.lit("m")).collect()}
    assert m["a"].total_pages == 3 and m["a"].fallback_pages == 0


def documents(spark, rows):
    d = spark.createDataFrame(rows, "doc string, text string, spans array<array<bigint>>")
    return d.select("text", F.struct(F.col("doc").alias("Source-File")).alias("metadata"), F.struct(F.col("spans").alias("pdf_page_numbers")).alias("attributes"))


def test_pages_of_any_spans(spark):
    rows = []
    for n in (0, 1, 4095, 4096, 4097, 65537, 140000):
        ends = [0, 1, 3000, 4095, 4096, 4097, 9000, 65536, n - 1, n, n + 9]
        spans = [(a, z) for a in ends for z in ends if a >= 0]
        rows.append((f"d{n}", "".join("ab é😀\nж"[i * i % 7] for i in range(n)), [[a, z, i] for i, (a, z) in enumerate(spans)]))
    rows += [("none", None, [[0, 3, 1]]), ("open", "abc", [[None, 3, 1], [0, None, 2], [1, 3, None]]), ("no spans", "abc", None)]
    got = {(r.doc, r.page): r.text for r in pg.explode_pages(documents(spark, rows), F.lit("m")).collect()}
    want = {(doc, p): text and text[a:z] for doc, text, spans in rows for a, z, p in spans or [] if None not in (a, z) and z > a}
    assert got == want


def test_a_long_document_costs_no_more_than_its_pages(spark, tmp_path):
    def seconds(docs, pages):
        path = str(tmp_path / f"{docs}")
        text, spans = F.repeat(F.lit("één page and more of it. "), pages * 10), F.transform(F.sequence(F.lit(0), F.lit(pages - 1)), lambda i: F.array(i * 250, i * 250 + 250, i).cast("array<bigint>"))
        spark.range(0, docs, 1, 1).select(text.alias("text"), F.struct(F.col("id").cast("string").alias("Source-File")).alias("metadata"), F.struct(spans.alias("pdf_page_numbers")).alias("attributes")).write.parquet(path)
        d, times = spark.read.parquet(path), []
        for _ in range(2):
            began = time.time()
            assert pg.explode_pages(d, F.lit("m")).agg(F.count("*"), F.sum(F.length("text"))).first()[:] == (docs * pages, docs * pages * 250)
            times.append(time.time() - began)
        return min(times)

    assert seconds(1, 5000) < 4 * seconds(500, 10) + 1


def test_outcomes(spark):
    rows = [(10, 0, 0.004), (1000, 1, 0.004), (12, 9, 0.004), (1000, 4, 0.004), (0, 0, 0.004), (10, 10, 1.0)]
    got = [spark.range(1).select(pg.classify_document(F.lit(a), F.lit(b), c)).first()[0] for a, b, c in rows]
    assert got == ["ok", "partial", "discarded", "partial", "discarded", "partial"]


def test_attempts(spark):
    refusal, lost = "I cannot help with that.", "��� broken text of a page"
    rows = [("clean", 1, 0, 200, "A clean page.", 5, 5, 0.5), ("refused", 1, 0, 200, refusal, 5, 5, 0.5), ("refused", 1, 1, 200, "A clean page.", 5, 5, 0.5), ("blank", 1, 0, 200, "", 5, 5, 0.002), ("retry", 1, 0, 200, lost, 5, 5, 0.5),
            ("retry", 1, 1, 200, "Now it is right.", 7, 7, None), ("down", 1, 0, 500, None, 0, 0, None), ("down", 1, 9, 200, "Too late for it.", 0, 0, None)]
    a = pg.evaluate_attempts(spark.createDataFrame(rows, "doc string, page int, attempt int, status int, raw string, input_tokens bigint, output_tokens bigint, ink double"))
    layer = spark.createDataFrame([("refused", 1, "layer text")], "doc string, page int, layer string")
    got = {r.doc: r for r in pg.selected_pages(a, ["doc", "page"], layer).collect()}
    assert {k: (r.attempt, r.is_fallback, r.natural_text, r.output_tokens) for k, r in got.items()} == {
        "clean": (0, False, "A clean page.", 5), "refused": (None, True, "layer text", 0), "blank": (0, False, None, 5), "retry": (1, False, "Now it is right.", 7), "down": (None, True, None, 0)}
    assert [r[0] for r in spark.range(10).select(pg.temperature(F.col("id").cast("int"))).collect()][-3:] == [1.0, 1.0, 1.0]


def test_duplicates_and_checksums(spark):
    d = spark.createDataFrame([("m", "a")] * 2, "model string, f string").select("model", F.lit("t").alias("text"), F.struct(F.col("f").alias("Source-File")).alias("metadata"))
    with pytest.raises(ValueError, match="duplicate"):
        pg.require_unique(d)
    p = spark.createDataFrame([("m", "a", 2, "b"), ("m", "a", 1, "é")], "model string, doc string, page int, text string")
    assert pg.document_checksums(p).first().text_sha1 == hashlib.sha1("1\0é\0002\0b\0".encode()).hexdigest()
    assert pg.assemble(spark.createDataFrame([], FIELDS), ["doc"], "v").count() == 0
