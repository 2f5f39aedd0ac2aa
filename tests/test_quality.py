import pytest
from pyspark.sql import functions as F

from pagewright.functions import quality as q

LONG = "The witness said that the matter was settled years ago and nobody asked again about item %d. "
CASES = [
    ("# Title\n\nA normal paragraph of text.", "ok"), ("  \n ", "empty_output"), (None, "empty_output"), ("bad ��� text here in the middle of some words", "mojibake"), ("a\x07b text of a page", "control_characters"),
    ("I'm sorry, but I cannot help with that.", "refusal"), ("".join(LONG % i for i in range(9)) + " I'm sorry, said he.", "ok"), ("He cannot provide the deed before May.", "ok"),
    ("Name: " + "_" * 40, "ok"), ("x" + "a" * 40, "repeated_character"), ("— " * 60, "repeated_ngram"), ("spam eggs " * 30, "repeated_ngram"), ("---\ntitle: [a\n---\nText of the page", "malformed_frontmatter"),
    ("---", "malformed_frontmatter"), ("---\na: b\n---\nbody text of it", "ok"), ("A text that goes on and...", "truncation_indicator"), ("It ends [...]", "truncation_indicator"), ("abc", "length_anomaly"),
]


def test_kinds(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: r.k for r in df.select("i", q.kind(q.assess(F.col("t"))).alias("k")).collect()}
    assert {i: got[i] for i in got} == {i: k for i, (_, k) in enumerate(CASES)}
    t = df.select("i", q.strip(F.coalesce("t", F.lit(""))).alias("t"))
    assert {r.i: r.k for r in t.select("i", q.verdict(F.col("t")).alias("k")).collect()} == got


def test_checks_can_be_switched_off(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    assert {r.k for r in df.select(q.kind(q.assess(F.col("t"), ["all"])).alias("k")).collect()} == {"ok"}
    one = spark.createDataFrame([("a\x07b ���",)], "t string").select(q.assess(F.col("t")).alias("a"), q.assess(F.col("t"), ["mojibake"]).alias("b")).first()
    assert one.a == ["mojibake", "control_characters"] and one.b == ["control_characters"]


def test_retry_and_blank(spark):
    df = spark.createDataFrame([("ok", 0.5), ("refusal", 0.001), ("empty_output", 0.001), ("empty_output", None), ("mojibake", 0.001)], "k string, ink double")
    got = df.select(q.retry_class(F.col("k")), q.is_blank_page(F.col("k"), F.col("ink"))).collect()
    assert [tuple(r) for r in got] == [("none", False), ("terminal", False), ("retryable", True), ("retryable", False), ("retryable", False)]
