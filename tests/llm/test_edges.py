"""Every query on empty tables, and on tables of nulls, blanks, very long texts, repeated rows and clashing extra columns."""

import datetime

import pytest

from pagewright.llm import queries as q

CLASH = ", tbl string, record_id bigint, seen bigint, share double, kind string, place int, shard int, n bigint, is_case boolean, _row string"
SCHEMAS = {
    "page_responses": "response_id bigint, model string, source_path string, page_num int, attempt int, primary_language string, natural_text string, is_valid boolean, ingested_at timestamp",
    "page_texts": "text_id bigint, model string, doc string, page int, text string",
    "correction_rate": "model string, doc string, page int, correction_rate double, uncorrectable_rate double",
    "garbage_fraction": "model string, doc string, page int, score double",
    "peer_agreement": "model string, peer string, doc string, page int, bow_f1 double, one_minus_ned double",
    "pplx": "model string, doc string, page int, ppl_raw double",
    "documents": "doc_id bigint, text string, lang string, source string",
    "doc_kinds": "doc_id bigint, kind string, labelled_by string", "mix_targets": "source string, target_share double, max_repeats int",
    "pack_specs": "spec_name string, capacity_tokens int", "common_words": "lang string, word string, pos int",
}
NOW = datetime.datetime(2025, 1, 1)
TEXTS = ["The cat sat on the mat and the dog of the house was there.\n\nOne line.", "", " \n\t ", None, "word " * 20_000, "é" * 5_000, "a\tb\n1\t2", "La régie des eaux a réglé la note."]
ROWS = {
    "page_responses": [(i, "m", "d", i, 0, x, t, None, NOW) for i, (t, x) in enumerate(zip(TEXTS, ["en", None, "", "xx", "English", "fr-FR", "de", None]))] * 2 + [(None,) * 9, (3, None, None, None, None, None, "x", None, None)],
    "page_texts": [(i, "m", "d", i, t) for i, t in enumerate(TEXTS)] * 2 + [(None,) * 5],
    "correction_rate": [(m, "d", 1, .1, .1) for m in "abc"] * 2 + [(None,) * 5, ("a", "d", 2, None, None)], "garbage_fraction": [(m, "d", 1, .1) for m in "abc"] + [(None,) * 4, ("a", "d", 2, float("nan"))],
    "peer_agreement": [(m, "z", "d", 1, .5, .5) for m in "abc"] + [(None,) * 6], "pplx": [(m, "d", 1, 3.0) for m in "abc"] + [(None,) * 4],
    "documents": [(i, t, x, s) for i, (t, x, s) in enumerate(zip(TEXTS, ["en", None, "fr", "en", "en", "fr", "de", "fr"], ["s", None, "s", "t", "t", "u", "s", "s"]))] + [(None,) * 4],
    "doc_kinds": [(0, "prose", None), (0, "list", None), (0, "list", "r"), (6, "table", None), (6, "table", None), (None, None, None), (7, "odd", None)], "mix_targets": [("s", .5, 2), ("none", .2, 1), (None, None, None)],
    "pack_specs": [("p", 1000), (None, None)], "common_words": [("en", "the", 1), ("en", "of", 2), ("fr", "la", 1), (None, None, None)],
}


@pytest.fixture(scope="module", params=["empty", "odd"])
def tables(request, spark, tmp_path_factory):
    d = tmp_path_factory.mktemp(request.param)
    for name, ddl in SCHEMAS.items():
        df = spark.createDataFrame([] if request.param == "empty" else ROWS[name], ddl)
        have = set(df.columns)
        for c in CLASH.strip(", ").split(", "):
            k, t = c.split()
            if k not in have:
                df = df.selectExpr("*", f"cast(null as {t}) as {k}")
        df.coalesce(1).write.parquet(str(d / f"{name}.parquet"))
    return request.param, str(d)


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query_runs(spark, tables, name):
    how, d = tables
    rows = q.queries()[name](spark, d).collect()
    if how == "empty":
        assert len(rows) == 0 or name in ("p9_shares",)
    elif name == "p4_found":
        assert [tuple(r) for r in rows] == [("d", "a")]  # all tie: the first name
    elif name == "p5_found":
        assert {tuple(r) for r in rows} == {("page_responses", 4), ("page_texts", 4)}
    elif name == "p8_found":
        assert {r.doc_id for r in rows} >= {4}
    elif name == "p9_found":
        assert "none" in {r.source for r in rows}
    elif name.endswith("_found"):
        assert len({tuple(r) for r in rows}) == len(rows)
