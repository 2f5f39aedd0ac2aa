"""Problem 4: one ranking from several differently scaled scores.

Leximin: each score becomes a percentile, an item's own percentiles are sorted ascending, and the sorted arrays are compared
lexicographically, so that what is weak cannot be masked. Compared as they are, the weakest score alone decides, and a run
that is best in three scores falls behind one that is middling in all. Each score shall have the same say, so by default the
array holds the means that leave one score out (``leave_out=1``); ``leave_out=0`` compares the percentiles themselves.

Percentiles are exact within a group, whose items are few; over all items they come from a mergeable quantile sketch.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read


def percentiles(items: DataFrame, scores: dict[str, bool], grid: int = 1000) -> DataFrame:
    """Adds ``p_<score>`` in [0, 1] over all items, 1 the best; ``scores`` tells for each whether higher is better. Equal scores get the same.

    Percentiles come from a mergeable quantile sketch, and no task sees all items. A null score gets no percentile (null).
    """
    out = items
    for s, higher in scores.items():
        v = F.col(s) if higher else -F.col(s)
        edges = items.agg(F.percentile_approx(v, [i / grid for i in range(grid + 1)], 10 * grid).alias("q")).first()["q"]
        if edges is None:
            p = F.lit(None).cast("double")
        else:
            a = F.array(*[F.lit(float(x)) for x in edges])
            n_below = lambda op: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + op(x).cast("double"))
            p = F.when(v.isNotNull(), (n_below(lambda x: x < v) + n_below(lambda x: x <= v)) / (2 * (grid + 1)))
        out = out.withColumn(f"p_{s}", p.cast("double"))
    return out


def leximin_vector(ps: list[Column], leave_out: int = 1) -> Column:
    """The array to compare, greatest first: sorted means of the percentiles with ``leave_out`` of them left out."""
    if leave_out:
        ps = [sum(c[1:], c[0]) / len(c) for c in combinations(ps, max(1, len(ps) - leave_out))]
    return F.array_sort(F.array(*[F.round(p, 9) for p in ps]))


def leximin_ranking(items: DataFrame, scores: dict[str, bool], by: list[str], tie: list[str], leave_out: int = 1, least: int = 1) -> DataFrame:
    """Adds the percentiles ``p_<score>`` and ``place`` (1 the best) within each group of ``least`` such items or more. Items that lack a score are left out; ties fall to the order of
    ``tie``, nulls first.

    A group's items are few (the runs of a document), so they are compared within one array: one exchange serves all scores.
    """
    full = items.where(" and ".join(f"{s} is not null and not isnan({s})" for s in scores))
    rest = [c for c in full.columns if c not in by]
    g = full.groupBy(*by).agg(F.collect_list(F.struct(*rest)).alias("_i")).withColumn("_n", F.size("_i")).where(F.col("_n") >= least)

    def percentile(e: Column, s: str, higher: bool) -> Column:
        below = F.size(F.filter("_i", lambda x: (x[s] < e[s]) if higher else (x[s] > e[s])))
        same = F.size(F.filter("_i", lambda x: x[s] == e[s])) - 1
        return F.when(F.col("_n") > 1, (below + same / 2) / (F.col("_n") - 1)).otherwise(F.lit(1.0))

    g = g.withColumn("_p", F.transform("_i", lambda e: F.struct(*[percentile(e, s, higher).alias(s) for s, higher in scores.items()])))
    vector = lambda i: F.transform(leximin_vector([F.get("_p", i)[s] for s in scores], leave_out), lambda x: -x)
    order = F.array_sort(F.transform("_i", lambda e, i: F.struct(vector(i).alias("v"), *[e[t].alias(t) for t in tie], i.alias("i"))))
    out = g.select(*by, "_i", "_p", F.posexplode(order).alias("_at", "_o"))
    e, p = F.get("_i", F.col("_o.i")), F.get("_p", F.col("_o.i"))
    return out.select(*by, *[e[c].alias(c) for c in rest], *[p[s].alias(f"p_{s}") for s in scores], (F.col("_at") + 1).alias("place")).select(*items.columns, *[f"p_{s}" for s in scores], "place")


SCORES = {"correction_rate": False, "garbage": False, "bow_f1": True, "ppl_raw": False}


def run_scores(spark, sf_dir) -> DataFrame:
    """``doc, model`` with the mean of each score over the run's pages; re-delivered rows count once.

    Only runs with all four scores are kept: a score that is null or missing throughout leaves its run out.
    """
    sources = {"correction_rate": ("correction_rate", "correction_rate"), "garbage": ("garbage_fraction", "score"), "bow_f1": ("peer_agreement", "bow_f1"), "ppl_raw": ("pplx", "ppl_raw")}
    rows = None
    for score, (table, column) in sources.items():
        t = read(spark, sf_dir, table)
        t = t.select("doc", "model", "page", (F.col("peer") if "peer" in t.columns else F.lit(None).cast("string")).alias("peer"), F.lit(score).alias("score"), F.col(column).cast("double").alias("v"))
        rows = t if rows is None else rows.unionByName(t)
    rows = rows.where("doc is not null and model is not null and v is not null and not isnan(v)")
    once = rows.groupBy("doc", "model", "page", "peer", "score").agg(F.max("v").alias("v"))
    mean = [F.avg(F.when(F.col("score") == s, F.col("v"))).alias(s) for s in SCORES]
    return once.groupBy("doc", "model").agg(*mean).where(" and ".join(f"{s} is not null" for s in SCORES))


def document_ranking(spark, sf_dir, least_runs: int = 3) -> DataFrame:
    """The place of each run in each document with at least ``least_runs`` complete runs."""
    return leximin_ranking(run_scores(spark, sf_dir), SCORES, ["doc"], ["model"], least=least_runs)


def p4_found(spark, sf_dir):
    return document_ranking(spark, sf_dir).where("place = 1").select("doc", "model")


def p4_ranking(spark, sf_dir):
    """All places, with the percentiles they come from."""
    return document_ranking(spark, sf_dir).select("doc", "model", "place", *[F.round(f"p_{s}", 6).alias(f"p_{s}") for s in SCORES])


_PLACES = """
with s as (
  select a.doc, a.model, a.v as correction_rate, b.v as garbage, c.v as bow_f1, d.v as ppl_raw
  from (select doc, model, avg(v) as v from (select doc, model, page, max(correction_rate) as v from correction_rate where correction_rate is not null group by all) group by all) a
  join (select doc, model, avg(v) as v from (select doc, model, page, max(score) as v from garbage_fraction where score is not null group by all) group by all) b using (doc, model)
  join (select doc, model, avg(v) as v from (select doc, model, page, peer, max(bow_f1) as v from peer_agreement where bow_f1 is not null group by all) group by all) c using (doc, model)
  join (select doc, model, avg(v) as v from (select doc, model, page, max(ppl_raw) as v from pplx where ppl_raw is not null and not isnan(ppl_raw) group by all) group by all) d using (doc, model)),
n as (select *, count(*) over (partition by doc) as n from s),
r as (select *,
  (rank() over (partition by doc order by -correction_rate) - 1 + count(*) over (partition by doc order by -correction_rate range unbounded preceding) - 1) / 2.0 / (n - 1) as p1,
  (rank() over (partition by doc order by -garbage) - 1 + count(*) over (partition by doc order by -garbage range unbounded preceding) - 1) / 2.0 / (n - 1) as p2,
  (rank() over (partition by doc order by bow_f1) - 1 + count(*) over (partition by doc order by bow_f1 range unbounded preceding) - 1) / 2.0 / (n - 1) as p3,
  (rank() over (partition by doc order by -ppl_raw) - 1 + count(*) over (partition by doc order by -ppl_raw range unbounded preceding) - 1) / 2.0 / (n - 1) as p4
  from n where n >= 3),
v as (select *, list_sort([round((p1+p2+p3)/3, 9), round((p1+p2+p4)/3, 9), round((p1+p3+p4)/3, 9), round((p2+p3+p4)/3, 9)]) as vec from r),
o as (select doc, model, row_number() over (partition by doc order by vec desc, model)::int as place, p1, p2, p3, p4 from v)
"""
FOUND_SQL = _PLACES + "select doc, model from o where place = 1"
RANKING_SQL = _PLACES + "select doc, model, place, round(p1, 6)::double as p_correction_rate, round(p2, 6)::double as p_garbage, round(p3, 6)::double as p_bow_f1, round(p4, 6)::double as p_ppl_raw from o"
