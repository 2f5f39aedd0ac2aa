import json

import pytest
from pyspark.sql import functions as F

from pagewright.functions import parsers as p


def parse(spark, name, raw):
    return spark.createDataFrame([(raw,)], "raw string").select(p.parser(name)(F.col("raw")).alias("p")).first().p


def test_markdown(spark):
    assert parse(spark, "markdown", "```markdown\n# A\n\n```py\nx\n```\nend\n```\n").natural_text == "# A\n\n```py\nx\n```\nend"
    assert parse(spark, "markdown", "```\nA\n```").natural_text == "A" and parse(spark, "markdown", "  ").natural_text is None and parse(spark, "markdown", None).natural_text is None


def test_front_matter(spark):
    raw = "---\nprimary_language: en\nis_rotation_valid: True\nrotation_correction: 90\nis_table: false\nis_diagram: no\n---\n\n# Page\n"
    r = parse(spark, "olmocr", raw)
    assert (r.primary_language, r.is_rotation_valid, r.rotation_correction, r.is_table, r.is_diagram, r.natural_text, r.error) == ("en", True, 90, False, False, "# Page", None)
    assert parse(spark, "olmocr", raw.replace("en\n", "no\n")).primary_language is None
    assert "missing" in parse(spark, "olmocr", raw.replace("is_table: false\n", "")).error and "unexpected" in parse(spark, "olmocr", raw.replace("is_table", "x: 1\nis_table")).error
    assert parse(spark, "olmocr", raw.replace("90", "45")).error == "rotation_correction" and "missing" in parse(spark, "olmocr", "plain").error


def test_tables_pictures_and_grounding(spark):
    assert parse(spark, "qianfan-ocr", "<think>hm</think>\n<TABLE><tr></tr></TABLE>").is_table and "</think>" in parse(spark, "qianfan-ocr", "a </think> b").natural_text
    r = parse(spark, "ovisocr2", 'A\n\n<img src="images/bbox_1_2_3_4.jpg" />\n\nB')
    assert r.natural_text == "A\n\nB" and r.is_diagram and not r.is_table
    assert parse(spark, "unlimited-ocr", "<|ref|>Title<|/ref|><|det|>[[1,2]]<|/det|>\nx<|end|><｜e｜>").natural_text == "Title\nx"


def test_layout(spark):
    raw = ('<div data-label="Section-Header" data-bbox="1"><b><u>Head <i>x</i></u></b></div><div data-label="Text"><p>Sum <math>a+b</math> and <b>bold</b></p><math display="block">c</math></div>'
           '<div data-label="Table"><table><tr><th>A</th><th>B</th></tr><tr><td>1</td></tr></table></div><ol><li>1. given</li><li>plain</li></ol>')
    r = parse(spark, "surya2", raw)
    assert "# Head x" in r.natural_text and "\\( a+b \\)" in r.natural_text and "\\[ c \\]" in r.natural_text and "| A | B |\n| --- | --- |\n| 1 |  |" in r.natural_text
    assert "1. given" in r.natural_text and "1. 1." not in r.natural_text and "**bold**" in r.natural_text and r.is_table and not r.is_diagram
    assert p.layout_to_markdown("<div>" * 5000 + "deep") == "deep"


def test_layout_keeps_links_quotes_code_and_spans():
    to = p.layout_to_markdown
    assert to('<p>See <a href="u/v" title="t">the map</a> and <a href="http://x">http://x</a> and <a>none</a>.</p>') == 'See [the map](u/v "t") and <http://x> and none.'
    assert to("<blockquote><p>one</p><p>two</p></blockquote><p>after</p>") == "> one\n>\n> two\n\nafter"
    assert to("<p>x</p><pre>a  b\n  c</pre>") == "x\n\n```\na  b\n  c\n```" and to("<pre><code>y = 1\n</code></pre>") == "```\ny = 1\n```"
    assert to('<table><tr><th colspan="2">A</th><th>B</th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>') == "| A |  | B |\n| --- | --- | --- |\n| 1 | 2 | 3 |"


def test_requests(spark):
    assert p.render_size("surya2") == 1540 and p.render_size("surya2", 900) == 900
    c = p.page_request(F.lit("QUJD"), F.lit('Read "this"\n'), F.lit(0.1), "qianfan-ocr", "served")
    r = json.loads(spark.range(1).select(c.alias("r")).first().r)
    assert r["messages"] == [{"role": "user", "content": [{"type": "text", "text": 'Read "this"\n'}, {"type": "image_url", "image_url": {"url": "data:image/png;base64,QUJD"}}]}]
    assert (r["model"], r["temperature"], r["max_tokens"], r["top_p"]) == ("served", 0.1, 12000, 1.0)
    assert json.loads(spark.range(1).select(p.page_request(F.lit("x"), F.lit("y"), F.lit(0.2), "markdown", "m").alias("r")).first().r)["max_tokens"] == 8000


def test_registry(spark):
    assert p.adapters(spark).count() == 10
    with pytest.raises(ValueError, match="choose from"):
        p.parser("nope")
