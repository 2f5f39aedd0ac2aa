import json

import pytest
from pyspark.sql import functions as F

from pagewright.operators import agreement, leaderboard as lb, pages, spelling, store as st
from pagewright.plans.evaluate import evaluate
from pagewright.schemas import ATTEMPTS, METRICS
from pagewright.sources import sinks


def metric(spark, rows):
    return spark.createDataFrame(rows, "model string, doc string, page int, score double")


def test_win_rates(spark):
    rows = [("a", d, 1, v) for d, v in (("d1", .1), ("d2", .2), ("d3", .5), ("d4", .0))] + [("b", d, 1, v) for d, v in (("d1", .3), ("d2", .4), ("d3", .1))]
    got = {r.model: (r.x, r.x_win) for r in lb.metric_columns(metric(spark, rows), F.col("score"), "x", False).collect()}
    assert got == {"a": (0.2, 0.666667), "b": (0.266667, 0.333333)}
    one = lb.metric_columns(metric(spark, [("a", "d1", p, .9) for p in (1, 2, 3)] + [("a", "d2", 1, .0)]), F.col("score"), "x", False).first()
    assert one.x == 0.45 and one.x_win is None
    tie = {r.x_win for r in lb.metric_columns(metric(spark, [("a", "d", 1, .5), ("b", "d", 1, .5)]), F.col("score"), "x", True).collect()}
    assert tie == {1.0}
    near = metric(spark, [("a", "d", 1, .5), ("b", "d", 1, .5 + 1e-9)])
    exact = {r.model: r.x_win for r in lb.metric_columns(near, F.col("score"), "x", True, None).collect()}
    assert exact == {"a": 0.0, "b": 1.0} and {r.x_win for r in lb.metric_columns(near, F.col("score"), "x", True).collect()} == {1.0}


def test_leaderboard_text(spark):
    t = {"garbage_fraction": metric(spark, [("a", "d", 1, .25), ("b", "d", 1, .5)]), "runs": spark.createDataFrame([("c",)], "model string")}
    board = lb.leaderboard(t)
    assert board.count() == 3 and board.where("model = 'c'").first().garbage is None
    text = lb.render(board)
    assert "0.250" in text and "n/a" in text and text.splitlines()[0].startswith("model") and lb.render(board.where("false")) == "(no models)"


def test_store_updates(spark):
    old = metric(spark, [("a", "d", 1, 1.), ("a", "e", 1, 2.), ("b", "d", 1, 3.)])
    new = metric(spark, [("a", "d", 1, 9.), ("a", "d", 1, 8.)])
    assert sorted(tuple(r) for r in st.upsert(old, new, ["model", "doc", "page"]).collect()) == [("a", "d", 1, 9.), ("a", "e", 1, 2.), ("b", "d", 1, 3.)]
    assert st.replace_groups(old, new.limit(0), ["model"]).count() == 3 and st.replace_groups(old, new.limit(1), ["model"]).count() == 2
    done = spark.createDataFrame([("a", "e")], "model string, doc string")
    assert st.replace_documents(old, new.limit(0), done).count() == 2
    pairs = spark.createDataFrame([("a", "b", "d", 1), ("b", "a", "d", 1), ("b", "c", "e", 1)], "model string, peer string, doc string, page int")
    assert st.clear_run(pairs, "a").count() == 1 and st.prune(pairs, "a", done.limit(0)).count() == 1
    assert st.clear_peer_documents(pairs, spark.createDataFrame([("a", "d")], "model string, doc string")).count() == 1
    p = spark.createDataFrame([("a", "d", 1), ("b", "d", 1), ("c", "d", 1)], "model string, doc string, page int")
    miss = {(r.model, r.peer) for r in st.missing_pairs(p, pairs).collect()}
    assert miss == {("a", "c"), ("b", "c")}


def test_registry(spark):
    runs = spark.createDataFrame([("a", "p", "s1")], "model string, input_path string, pplx_scorer_model string")
    pplx = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "model string, ppl_raw double")
    r, p = st.register(runs, "a", "q", None, pplx)
    assert tuple(r.first()) == ("a", "q", "s1") and p.count() == 2
    r, p = st.register(runs, "a", "q", "s2", pplx)
    assert tuple(r.first()) == ("a", "q", "s2") and [x.model for x in p.collect()] == ["b"]


def test_failed_commit_keeps_the_old_version(spark, tmp_path):
    s = st.MetricStore(spark, f"file://{tmp_path}/store")
    s.commit(garbage_fraction=metric(spark, [("a", "d", 1, .5)]))
    with pytest.raises(Exception):
        s.commit(garbage_fraction=metric(spark, [("a", "d", 1, .9)]), ledger=spark.range(1))
    assert s.read("garbage_fraction").first().score == .5 and s.read("ledger").count() == 0
    with pytest.raises(ValueError, match="phase"):
        s.write_phase("nope", metric(spark, []), None)


def test_a_crash_before_the_rename_leaves_the_last_version(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/store"
    s = st.MetricStore(spark, path)
    s.commit(garbage_fraction=metric(spark, [("a", f"d{i}", 1, .5) for i in range(20)]))
    before = sorted(map(tuple, s.read("garbage_fraction").collect()))
    monkeypatch.setattr(st.MetricStore, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("power cut")))
    with pytest.raises(RuntimeError, match="power"):
        s.commit(garbage_fraction=metric(spark, []))
    monkeypatch.undo()
    again = st.MetricStore(spark, path)
    assert sorted(map(tuple, again.read("garbage_fraction").collect())) == before and again.version() == 1


def test_of_two_writers_one_is_told(spark, tmp_path):
    s = st.MetricStore(spark, f"file://{tmp_path}/store")
    s.commit(garbage_fraction=metric(spark, [("a", "d", 1, .5)]))
    s._publish(2, {})
    with pytest.raises(RuntimeError, match="another writer"):
        s._publish(2, {("garbage_fraction", 0): "x"})
    assert s.version() == 2 and s.read("garbage_fraction").count() == 0


def test_a_phase_rewrites_only_the_parts_it_touches(spark, tmp_path):
    s = st.MetricStore(spark, f"file://{tmp_path}/store")
    s.commit(garbage_fraction=metric(spark, [("a", f"d{i}", 1, .5) for i in range(200)]))
    old = s._parts(1)
    done = spark.createDataFrame([("a", "d7", "sum")], "model string, doc string, text_sha1 string")
    s.write_phase("garbage", metric(spark, [("a", "d7", 1, .9)]), done)
    new = s._parts(2)
    changed = {k for k in new if k[0] == "garbage_fraction" and new[k] != old.get(k)}
    got = {r.doc: r.score for r in s.read("garbage_fraction").collect()}
    assert len(changed) == 1 and len(old) > 40 and got.pop("d7") == .9 and set(got.values()) == {.5} and len(got) == 199
    s.write_phase("garbage", metric(spark, []), done)
    assert s.read("garbage_fraction").count() == 199 and s.read("ledger").count() == 1


def test_runs_are_pruned_together(spark):
    pairs = spark.createDataFrame([("a", "b", "d", 1), ("b", "a", "d", 1), ("b", "c", "e", 1), ("c", "d", "z", 1)], "model string, peer string, doc string, page int")
    keep = spark.createDataFrame([("a", "d"), ("b", "d")], "model string, doc string")
    assert sorted(map(tuple, st.prune_runs(pairs, ["a", "b"], keep).collect())) == [("a", "b", "d", 1), ("b", "a", "d", 1), ("c", "d", "z", 1)]


def test_a_source_named_twice_is_an_error(spark):
    d = spark.createDataFrame([("a", ("x",)), ("a", ("x",)), ("b", ("x",))], "model string, metadata struct<`Source-File`: string>")
    with pytest.raises(ValueError, match="'x' in run 'a'"):
        pages.require_unique(d)
    assert pages.require_unique(d.distinct()).count() == 2


def test_rejects_follow_evaluated_attempts(spark):
    rows = [("d", 1, 0, 200, "A plain text of some length.", 1, 1, None), ("d", 1, 1, 200, "as an ai i cannot help", 1, 1, None), ("d", 1, 2, 500, "x", 1, 1, None)]
    a = pages.evaluate_attempts(spark.createDataFrame(rows, ATTEMPTS), "markdown")
    assert [(r.attempt, r.kind, r.text) for r in sinks.rejects(a).collect()] == [(1, "refusal", "as an ai i cannot help")]


def test_outcomes_count_each_document_once(spark):
    p = spark.createDataFrame([("ok", 1, False), ("half", 1, True), ("half", 2, False), ("boom", 1, False)], "doc string, page int, is_fallback boolean")
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "doc string")
    got = {r.outcome: r.n for r in pages.outcome_counts(p, ["doc"], 0.5, names("ok", "half", "boom", "lost"), names("boom", "gone")).collect()}
    assert got == {"ok": 1, "partial": 1, "crashed": 2, "missing": 1}


def test_peer_agreement_is_symmetric(spark):
    p = spark.createDataFrame([(m, "d", 1, t) for m, t in (("a", "x y"), ("b", "x z"), ("c", ""))], "model string, doc string, page int, text string")
    got = {(r.model, r.peer): r.bow_f1 for r in agreement.peer_agreement(p).collect()}
    assert len(got) == 6 and got["a", "b"] == got["b", "a"] == 0.5 and got["a", "c"] == 0.0


def test_textlayer_skips(spark):
    p = spark.createDataFrame([("m", d, 1, "some plain words of a whole page here") for d in "abcd"], "model string, doc string, page int, text string")
    metas = spark.createDataFrame([("m", "a", 1), ("m", "b", 0), ("m", "c", 0), ("m", "d", 0)], "model string, doc string, fallback_pages int")
    layer = spark.createDataFrame([("a", 1, "x" * 30, None), ("c", 1, "too short", None), ("d", 1, None, "some plain words of a whole page here now")], "doc string, page int, layer string, layer_2 string")
    s, skipped = agreement.textlayer_agreement(p, metas, layer)
    assert [r.doc for r in s.collect()] == ["d"] and {r.status: r.pages for r in skipped.collect()} == {"fallback": 1, "missing": 1, "blank": 1, "scored": 1}


def test_spelling(spark):
    words = spelling.dictionary(spark.createDataFrame([("the", 100), ("quick", 5), ("brown", 7), ("quack", 9)], "word string, count int"), spark.createDataFrame([("Zyx",)], "word string"))
    p = spark.createDataFrame([(1, "The quikc brwn zyx, xxxxxxxx 42"), (2, "123 !"), (3, "")], "id int, text string")
    r = {x.id: (x.n_tokens, x.n_corrected, x.n_uncorrectable) for x in spelling.correction_rates(p, words, ["id"]).collect()}
    assert r == {1: (5, 2, 1)}
    assert {x.id: x.text for x in spelling.correct_texts(p, words, ["id"]).collect()}[1] == "The quick brown zyx, xxxxxxxx 42"
    assert spelling.osa_distance("ab", "ba") == 1 and spelling.osa_distance("abc", "abcdef") == 3


def record(doc, pages):
    text, spans = "", []
    for i, t in enumerate(pages):
        c = t + ("\n" if i < len(pages) - 1 else "") if t else ""
        spans.append([len(text), len(text) + len(c), i + 1])
        text += c
    return json.dumps({"text": text, "metadata": {"Source-File": doc}, "attributes": {"pdf_page_numbers": spans}})


def tables(store):
    return {t: sorted(map(str, store.read(t).collect())) for t in ("correction_rate", "garbage_fraction", "peer_agreement", "reject_rate", "ledger")}


def test_resumed_equals_fresh(spark, tmp_path):
    words = spark.createDataFrame([("alpha", 5), ("beta", 5)], "word string, count bigint")
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text(record("x", ["alpha bta", "", "gmma"]) + "\n" + record("y", ["beta"]) + "\n")
    b.write_text(record("x", ["alpha beta", "", "gamma"]) + "\n")
    kept = st.MetricStore(spark, f"file://{tmp_path}/kept")
    evaluate(spark, kept, [f"a={a}"], words)
    evaluate(spark, kept, [f"a={a}", f"b={b}"], words)
    a.write_text(record("x", ["alpha beta new", "", "gmma"]) + "\n")
    board = evaluate(spark, kept, [f"a={a}", f"b={b}"], words)
    fresh = st.MetricStore(spark, f"file://{tmp_path}/fresh")
    evaluate(spark, fresh, [f"a={a}", f"b={b}"], words)
    assert tables(kept) == tables(fresh) and board.count() == 2
    assert not [r for r in kept.read("garbage_fraction").collect() if r.doc == "y"]


def letters(calls):
    """A scorer: a token a character, the first without a score; a chunk that holds 'fail' gets none."""

    def score(chunks):
        calls.append(sorted((r.model, r.doc, r.text) for r in chunks.collect()))
        t = chunks.where("text not like '%fail%'").select("model", "doc", "chunk", "text", F.posexplode(F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)))).alias("pos", "k"))
        c = F.substring("text", F.col("k"), F.lit(1))
        return t.select("model", "doc", "chunk", "pos", F.when(F.col("pos") > 0, c).alias("decoded"), F.when(F.col("pos") > 0, F.when(c == "b", -1.0).otherwise(-0.5)).alias("logprob"))

    return score


def test_perplexities_are_scored_once(spark, tmp_path):
    words = spark.createDataFrame([("alpha", 5), ("beta", 5)], "word string, count bigint")
    a = tmp_path / "a.jsonl"
    a.write_text(record("x", ["alpha", "", "bta b"]) + "\n" + record("y", ["fail"]) + "\n" + record("z", ["beta"]) + "\n")
    s, calls = st.MetricStore(spark, f"file://{tmp_path}/s"), []
    with pytest.warns(UserWarning, match="1 documents .* a: y"):
        board = evaluate(spark, s, [f"a={a}"], words, scorer=letters(calls), scorer_name="one", max_tokens=3)
    assert [x[2] for x in calls[0]] == ["alpha\n", "bta b", "fail", "beta"] and {x[1] for x in calls[1]} == {"x"} and "beta b" in [x[2] for x in calls[1]]
    got = {(r.doc, r.page): (r.n_tokens_raw, r.sum_logprob_raw, r.n_tokens_corrected) for r in s.read("pplx").collect()}
    assert got["z", 1] == (3.0, -1.5, 3.0) and got["x", 1] == (5.0, -2.5, 5.0) and got["x", 3] == (4.0, -2.5, 5.0) and ("y", 1) not in got and board.first().ppl_raw is not None
    assert {r.doc for r in s.read("ledger").where("phase = 'pplx'").collect()} == {"x", "z"}
    with pytest.warns(UserWarning):  # only what failed is tried again
        evaluate(spark, s, [f"a={a}"], words, scorer=letters(calls), scorer_name="one", max_tokens=3)
    assert {x[1] for x in calls[2]} == {"y"} and s.read("pplx").count() == len(got)
    a.write_text(record("z", ["beta"]) + "\n")  # what the run no longer has keeps its perplexities
    evaluate(spark, s, [f"a={a}"], words)
    assert s.read("pplx").count() == len(got) and s.read("garbage_fraction").count() == 1
    evaluate(spark, s, [f"a={a}"], words, scorer=letters(calls), scorer_name="two")  # another scorer
    assert {(r.doc, r.page) for r in s.read("pplx").collect()} == {("z", 1)}


def test_scores_without_a_record_are_adopted(spark, tmp_path):
    words = spark.createDataFrame([("beta", 5)], "word string, count bigint")
    a = tmp_path / "a.jsonl"
    a.write_text(record("z", ["beta"]) + "\n")
    s, calls = st.MetricStore(spark, f"file://{tmp_path}/s"), []
    s.commit(pplx=spark.createDataFrame([("a", "z", 1, 3.0, -1.0, 1.4, 3.0, -1.0, 1.4)], METRICS["pplx"]))
    evaluate(spark, s, [f"a={a}"], words, scorer=letters(calls))
    assert calls[0] == [] and s.read("pplx").first().sum_logprob_raw == -1.0
