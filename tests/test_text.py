import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import text as tx
from pagewright.functions.garbage import garbage_fraction, token_is_garbage
from pagewright.functions.agreement import bow_f1, edit_distance, multiset_f1, one_minus_ned
from pagewright.functions.loops import has_ngram_loop, has_tail_loop, trailing_repeats


def values(spark, texts, column, schema="t string"):
    rows = [(i, t) for i, t in enumerate(texts)]
    return [r.v for r in spark.createDataFrame(rows, "i int, " + schema).select("i", column.alias("v")).orderBy("i").collect()]


def test_garbage_tokens(spark):
    tokens = ["brwn", "PDF", "cat", "aaaa", "----", "a1b", "été", "x" * 41, "(" + "ab" * 20 + ")", "aBcDe", "fooBar", "12", "b2", "rhythm", "", "ÀÉ", "bcd.", "BcDf", "m²", "x²y", "①a", "½a"]
    got = values(spark, tokens, tx.is_garbage(F.col("t")))
    assert got == [token_is_garbage(t) for t in tokens]
    assert got == [True, False, False, True, True, True, True, True, False, True, False, False, True, False, False, False, True, True, True, True, True, False]


def test_garbage_fraction_nulls_and_blanks(spark):
    assert values(spark, [None, "", " \n ", "cat brwn", "cat"], tx.garbage_fraction(F.col("t"))) == [None, None, None, 0.5, 0.0]


def test_normalize_markdown(spark):
    assert values(spark, ["# A **b** [link](http://x)  `c`\n> d", None, ""], tx.normalize_markdown(F.col("t"))) == ["A b link c d", None, ""]


def test_markdown_paths(spark):
    got = values(spark, ["/a/b/c.pdf", "a/../b//x.tar.pdf", "/w/bundle.tar.gz::inner/doc.pdf", "/w/b.tgz::doc.pdf", "plain"], tx.markdown_path(F.col("t")))
    assert got == ["markdown/a/b/c.md", "markdown/a/b/x.tar.md", "markdown/bundle/inner/doc.md", "markdown/b/doc.md", "markdown/plain.md"]


def test_small_functions(spark):
    assert values(spark, ["http://h:1/v1/", "http://h:1/v1", "http://h:1/"], tx.metrics_url(F.col("t"))) == ["http://h:1/metrics"] * 3
    assert values(spark, ["a-b c/é"], tx.sanitize_name(F.col("t"))) == ["a_b_c_é"]
    assert values(spark, ["x RAW_TEXT_START\n hi \nRAW_TEXT_END y"], tx.raw_text_of_prompt(F.col("t"))) == ["hi"]
    assert values(spark, ["a.TAR.GZ", "a.tgz", "a.gz"], tx.is_tarball(F.col("t"))) == [True, True, False]
    r = spark.range(1).select(tx.format_rate(F.lit(None).cast("double")), tx.format_rate(F.lit(999.4)), tx.format_rate(F.lit(6100.0)), tx.elapsed(F.lit(90061.5)), tx.perplexity(F.lit(-2.0), F.lit(2)), tx.perplexity(F.lit(-2.0), F.lit(0))).first()
    assert tuple(r)[:4] == ("-", "999", "6.1k", "25:01:01") and math.isclose(r[4], math.e) and r[5] is None


def test_sniffing(spark):
    rows = [(bytearray(b"\x89PNG\r\n\x1a\n0"),), (bytearray(b"\xff\xd8\xff"),), (bytearray(b"%PDF-1.7"),), (bytearray(b"text"),)]
    assert [r.v for r in spark.createDataFrame(rows, "t binary").select(tx.sniff(F.col("t")).alias("v")).collect()] == ["png", "jpeg", "pdf", None]


def naive(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.text("abcé \n", max_size=40), st.text("abcé \n", max_size=40))
def test_edit_distance_matches_the_textbook(a, b):
    assert edit_distance(a, b) == naive(a, b)


def test_agreement(spark):
    rows = [("the cat sat on it", "it on sat cat the"), ("a b", "c d"), ("", ""), ("", "x"), (None, "x")]
    got = spark.createDataFrame(rows, "a string, b string").select(bow_f1(F.col("a"), F.col("b")).alias("f"), one_minus_ned(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.f for r in got] == [1.0, 0.0, 1.0, 0.0, None]
    assert got[0].n < 0.6 and got[2].n == 1.0 and got[3].n == 0.0 and got[4].n is None
    assert multiset_f1("a a b", "a b b") == 2 * 2 / 6


def test_loops():
    prose = "The second sentence says something else about number %d. "
    assert has_ngram_loop("blah blub " * 30) and not has_ngram_loop("one two three four five six") and has_ngram_loop("— " * 60) and not has_ngram_loop("")
    good = "".join(prose % i for i in range(20))
    assert has_tail_loop(good + "the unit goes round and round. " * 260) and has_tail_loop(good + "<tr>x y z</tr>" * 200 + "</table> and that was all")
    assert not has_tail_loop("".join(prose % (i * 7919) for i in range(130)) + "x" * 100) and not has_tail_loop("short")
    assert trailing_repeats("abcabcabc", 4) == [1, 1, 3, 1] and trailing_repeats("", 2) == [0, 0] and trailing_repeats("aaa", 2) == [3, 1]
