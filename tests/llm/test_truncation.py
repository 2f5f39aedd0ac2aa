import random

import numpy as np
from pyspark.sql import functions as F

from pagewright.llm import truncation


LONGEST = len(truncation.ORDERS) - 1


def bucket(s):
    most = truncation.ORDERS[-1]
    return int(truncation._buckets(list(truncation._codes([s.rjust(most, "\0")], most).T), 1)[0])


def odds(ends, text):
    return ends.odds([truncation.context(text)])[0].tolist()


def inner(passed, rid=0):
    return passed.where(f"response_id = {rid}").first().inner


def model(pairs, spark, kept=None):
    rows = truncation.commonest(truncation._contexts(spark.createDataFrame(pairs, "a string, b string, how string, n bigint")), kept).orderBy("key").collect()
    return truncation.Ends(np.array([r.key for r in rows], np.int64), np.array([[r.l, r.s, r.e] for r in rows], np.int32).clip(0))


def test_unseen_contexts_back_off(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(60_000)})
    ends = model([("", w, how, 1) for w in words for how in "we"] + [("", "zzqqqqqq", "w", 9)], spark)
    known = set(words)
    strange = [w for w in ("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(3000)) if w not in known]
    keys = set(ends.keys.tolist())
    assert len([k for k in keys if k >> truncation.BITS == LONGEST]) >= len(words)  # each context has counts of its own
    assert not [w for w in strange if (LONGEST << truncation.BITS) | bucket(w) in keys]
    known_by_two = sorted({w[-2:] for w in strange})
    assert (ends.odds([" zzzzz" + k for k in known_by_two]) == ends.odds([" xyxyx" + k for k in known_by_two])).all()


def test_commonest_contexts_are_kept(spark):
    rows = [(o << truncation.BITS | i, n, 0, 0) for o in range(5) for i, n in enumerate([1] * 50 + [100] * 20 + [5000] * 5)]
    df = spark.createDataFrame(rows, "key bigint, l bigint, s bigint, e bigint")
    kept = lambda n: sorted(r["count"] for r in truncation.commonest(df, n).groupBy(F.shiftright("key", truncation.BITS)).count().collect())
    assert kept(75) == [75] * 5 and kept(74) == [25] * 5 and kept(25) == [25] * 5 and kept(24) == [5] * 5 and kept(4) == []


def test_thresholds_see_all_inner_ends(spark):
    text = "Heading\n\nA sentence.\n\n• oak planks\n• lamp oil\n\nWater levels\n\na | b\nc | d"
    ends = model([("", w, how, n) for w, n in (("heading", 50), ("planks", 1), ("oil", 1), ("levels", 1)) for how in "we"] + [("", w, "w", 200) for w in ("planks", "oil", "levels")], spark)
    r = spark.createDataFrame([(i, "m", i, 1, text) for i in range(40)], "response_id bigint, model string, doc bigint, page_num int, natural_text string")
    common = spark.createDataFrame([("en", "a", 1)], "lang string, word string, pos int")
    passed = truncation.read_texts(r, common)
    assert inner(passed) == [" heading", "k planks", "lamp oil", "r levels", " | b"]
    rows = truncation.measure(passed, ends)
    low = min(x[0] for x in ends.odds(inner(passed)).tolist())
    got = truncation.thresholds(rows, 0.1).first().threshold
    assert odds(ends, "Heading")[0] > truncation.HIGHEST and low < truncation.HIGHEST and abs(got - max(low, truncation.LOWEST)) < 1e-4


def test_endings():
    whole = lambda t: [(x[1][-4:], x[2], x[3]) for x in truncation.endings(t)][-1]
    assert whole("a b\n<table><tr><td>x</td></tr></table>")[2] and whole("a\n<ul><li>oak</li></ul>")[2]
    assert whole("\\begin{tabular}{l}\noak & 4 \\\\\n\\end{tabular}\n\\end{document}")[2] and not whole("<p>the old qu</p>")[2]
    assert whole("the old quay [...]") == ("quay", True, False) and whole("it ended.\n\n- 7 -")[0] == "ded."
    titled = truncation.endings("the old quay was\n\nWater levels Gosk")
    assert [x[0] for x in titled] == ["Water levels Gosk", None] and titled[1][1].endswith("was")


def test_a_full_stop_that_other_runs_pass_is_a_cut(spark):
    stops = lambda t: truncation.stops(t.lower().split())
    start = "The treasurer returned the draft budget without any further comment. "
    more = "The survey office then measured the boundary stones near the old quay and replaced the index cards of the paper mill."
    assert len(stops(start + more)) == 1 and stops(start + start + more) == [] and stops(start) == []
    texts = {1: [("a", start), ("b", start + more), ("c", start + more)], 2: [("a", start), ("b", start), ("c", start + more)], 3: [("a", more + " " + start), ("b", start + more), ("c", start + more)]}
    rows = [(10 * p + i, m, 7, p * 2, t) for p, ts in texts.items() for i, (m, t) in enumerate(ts)]
    r = spark.createDataFrame(rows, "response_id bigint, model string, doc bigint, page_num int, natural_text string")
    common = spark.createDataFrame([("en", "the", 1)], "lang string, word string, pos int")
    passed = truncation.read_texts(r, common)
    rows = truncation.measure(passed, truncation.train(passed))
    m = spark.createDataFrame(rows.collect(), rows.schema)
    m = m.withColumn("odds", F.lit(1.0))
    assert {x.response_id: x.others for x in truncation.truncated(m).where("others > 0").collect()} == {10: 2, 20: 1, 21: 1}
    assert {x.response_id for x in truncation.truncated(m).where("is_cut").collect()} == {10}
    assert {x.response_id for x in truncation.truncated(m.withColumn("odds", F.when(F.col("response_id") == 20, -9.0).otherwise(1.0)).withColumn("tail", F.col("response_id"))).where("is_cut").collect()} == {10, 20}
