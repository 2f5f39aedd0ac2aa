"""Server metrics and counters: exposition text, snapshots, rates with reset detection, windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: The names of each logical metric, first hit wins; metrics that are averaged over engines; those that only grow.
CANDIDATES = {
    "generation_tokens": ("vllm:generation_tokens_total",), "prompt_tokens": ("vllm:prompt_tokens_total",),
    "cache_hits": ("vllm:prefix_cache_hits_total", "vllm:prompt_tokens_cached_total"), "cache_queries": ("vllm:prefix_cache_queries_total", "vllm:prompt_tokens_total"),
    "running": ("vllm:num_requests_running",), "waiting": ("vllm:num_requests_waiting",), "kv_usage": ("vllm:kv_cache_usage_perc", "vllm:gpu_cache_usage_perc"),
}
AVERAGED = ("kv_usage",)
MONOTONIC = ("generation_tokens", "prompt_tokens", "cache_hits", "cache_queries")
WINDOW = 60.0
_LINE = r"^([a-zA-Z_:][a-zA-Z0-9_:]*)(?:\{([^}]*)\})?\s+(\S+)\s*$"
_PAIR = r'([a-zA-Z_][a-zA-Z0-9_]*)="([^"]*)"'


def parse_exposition(text: Column) -> Column:
    """``array<struct<name, labels map<string,string>, value double>>``; comments, blank or malformed lines and values that are not finite are
    left out."""
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#") & x.rlike(_LINE))

    def sample(x: Column) -> Column:
        labels = F.regexp_extract(x, _LINE, 2)
        pairs = F.regexp_extract_all(labels, F.lit(f"({_PAIR})"), F.lit(1))
        entries = F.transform(pairs, lambda p: F.struct(F.regexp_extract(p, _PAIR, 1), F.regexp_extract(p, _PAIR, 2)))
        return F.struct(F.regexp_extract(x, _LINE, 1).alias("name"), F.map_from_entries(entries).alias("labels"), F.regexp_extract(x, _LINE, 3).try_cast("double").alias("value"))

    ok = lambda s: s["value"].isNotNull() & ~F.isnan(s["value"]) & (F.abs(s["value"]) < float("inf"))
    return F.filter(F.transform(lines, sample), ok)


def _named(name: str) -> Column:
    return F.filter("_s", lambda x: x["name"] == name)


def snapshots(scrapes: DataFrame, text: str = "text") -> DataFrame:
    """Adds one column a logical metric: summed over engines, fractions averaged, null where no candidate name is there. Null is no zero."""
    s = scrapes.withColumn("_s", parse_exposition(F.col(text)))
    for metric, names in CANDIDATES.items():
        options = []
        for name in names:
            v = _named(name)
            total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x["value"])
            options.append(F.when(F.size(v) > 0, total / F.size(v) if metric in AVERAGED else total))
        s = s.withColumn(metric, F.coalesce(*options))
    return s.drop("_s")


#: Seconds of a stretch: a key's rows are cut into stretches of time, so that no task holds all rows of a key.
STRETCH = 3600.0


def carried(rows: DataFrame, columns: dict[str, Column], stretch: float, inclusive: bool = False) -> DataFrame:
    """Adds ``columns``: of each row the last value that is not null before it (or up to it) in its key's order of time (in: ``_k, ts``).

    Each stretch gets what the stretches before it ended with as a row of its own; a window over a key sees one row a stretch.
    """
    cut = rows.withColumns({f"_v{i}": c for i, c in enumerate(columns.values())}).withColumn("_b", F.floor(F.col("ts") / stretch))
    n = range(len(columns))
    ends = cut.groupBy("_k", "_b").agg(*[F.max_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), F.col("ts"))).alias(f"_v{i}") for i in n])
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_k", "_b", *[F.last(f"_v{i}", ignorenulls=True).over(before).alias(f"_e{i}") for i in n])
    inside = Window.partitionBy("_k", "_b").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    both = cut.join(ends, ["_k", "_b"])
    return both.select(*rows.columns, *[F.coalesce(F.last(f"_v{i}", ignorenulls=True).over(inside), F.col(f"_e{i}")).alias(c) for i, c in enumerate(columns)])


def restarts(rows: DataFrame, fields: list[str], stretch: float) -> DataFrame:
    """Adds ``_restart``: whether a counter lies below the last value it had since the restart before. A null hides nothing and shows nothing.

    Restarts that are found too often (by a value from before another counter's restart) make the next round find too few, and so on; the rounds
    close in on the one answer, mostly at the second.
    """
    known = rows.withColumn("_restart", F.lit(False))
    while True:
        last = {f"_l_{f}": F.when(F.col(f).isNotNull(), F.struct(F.col("ts").alias("t"), F.col(f).alias("v"))) for f in fields}
        seen = carried(known, last | {"_since": F.when(F.col("_restart"), F.col("ts"))}, stretch)
        fell = F.lit(False)
        for f in fields:
            fell = fell | F.coalesce((F.col(f) < F.col(f"_l_{f}.v")) & (F.col("_since").isNull() | (F.col(f"_l_{f}.t") >= F.col("_since"))), F.lit(False))
        seen = materialise(seen.withColumn("_was", F.col("_restart")).withColumn("_restart", fell), "restarts")
        changed = not seen.where("_was <> _restart").isEmpty()
        known = seen.select(*rows.columns, "_restart")
        if not changed:
            return known


def _difference(f: str, old: str) -> Column:
    return F.col(f) - F.col(f"{old}.{f}")


def counter_rates(snaps: DataFrame, key: str = "server", ts: str = "ts", window: float = WINDOW, stretch: float = STRETCH) -> DataFrame:
    """``key, ts`` (seconds) and the rates after each snapshot: against the oldest one of the last ``window`` seconds, the snapshot before at
    least, and against the first one since the counters restarted. Of snapshots of one time the greatest values count; a null counter has no
    rate, a first snapshot neither.
    """
    fields = [f for f in CANDIDATES if f in snaps.columns]
    stretch = max(stretch, window)
    kind = dict(snaps.dtypes)[key]
    rows = snaps.where(F.col(ts).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(ts).cast("double").alias("ts")).agg(*[F.max(f).cast("double").alias(f) for f in fields])
    rows = rows.withColumn("_k", F.coalesce(F.xxhash64("_key"), F.lit(0)))
    rows = restarts(rows, [f for f in fields if f in MONOTONIC], stretch)
    row = F.struct("ts", *fields)
    rows = carried(rows, {"_prev": row}, stretch)
    rows = carried(rows, {"_first": F.when(F.col("_restart") | F.col("_prev").isNull(), row)}, stretch, inclusive=True)
    # The last seconds of a stretch stand before the next one too.
    cut = rows.withColumn("_b", F.floor(F.col("ts") / stretch)).withColumn("_row", row)
    late = cut.where(F.col("ts") >= (F.col("_b") + 1) * stretch - window).withColumn("_b", F.col("_b") + 1)
    both = cut.withColumn("_own", F.lit(True)).unionByName(late.withColumn("_own", F.lit(False)))
    oldest = F.expr(f"first(_row) over (partition by _k, _b, _first.ts order by ts range between cast({float(window)} as double) preceding and current row)")
    both = both.withColumn("_oldest", oldest).where("_own")
    alone = (F.col("_oldest.ts") == F.col("ts")) & (F.col("_prev.ts") >= F.col("_first.ts"))
    both = both.withColumn("_old", F.when(alone, F.col("_prev")).otherwise(F.col("_oldest")))
    none = F.lit(None).cast("double")

    def speed(f: str, old: str) -> Column:
        return F.try_divide(_difference(f, old), F.when(F.col("ts") > F.col(f"{old}.ts"), F.col("ts") - F.col(f"{old}.ts"))) if f in fields else none

    def hits(old: str) -> Column:
        if "cache_hits" not in fields or "cache_queries" not in fields:
            return none
        asked = _difference("cache_queries", old)
        return F.try_divide(_difference("cache_hits", old), F.when(asked > 0, asked))

    return both.select(F.col("_key").cast(kind).alias(key), F.col("ts").alias(ts), *[c.alias(n) for n, c in {
        "gen_tps": speed("generation_tokens", "_old"), "gen_tps_avg": speed("generation_tokens", "_first"),
        "prompt_tps": speed("prompt_tokens", "_old"), "prompt_tps_avg": speed("prompt_tokens", "_first"),
        "kv_hit": hits("_old"), "kv_hit_avg": hits("_first"), **{f: F.col(f) if f in fields else none for f in ("running", "waiting", "kv_usage")},
    }.items()])


RATES = "gen_tps double, gen_tps_avg double, prompt_tps double, prompt_tps_avg double, kv_hit double, kv_hit_avg double, running double, waiting double, kv_usage double"


def frame_rates(frame: pd.DataFrame, window: float = WINDOW) -> tuple[pd.DataFrame, np.ndarray]:
    """(the rates of each sample of one server, which samples later ones will need): ``counter_rates`` of a frame in order of time.

    Needed are the first sample since the restart, the window (two samples at least), and of each counter the last value.
    """
    n, t = len(frame), frame["ts"].to_numpy(float)
    value = {f: frame[f].to_numpy(float) if f in frame else np.full(n, np.nan) for f in CANDIDATES}
    first, at = np.zeros(n, int), 0
    while at < n:  # one step a restart
        fell = np.zeros(n - at, bool)
        for f in MONOTONIC:
            v = pd.Series(value[f][at:])
            fell |= (v < v.ffill().shift()).to_numpy()
        end = at + int(fell.argmax()) if fell.any() else n
        first[at:end] = at
        at = end
    here = np.arange(n)
    old = np.maximum(first, np.minimum(np.searchsorted(t, t - window), here - 1))

    def over(f: str, by: np.ndarray, base: np.ndarray) -> np.ndarray:
        return np.divide(value[f] - value[f][base], by, out=np.full(n, np.nan), where=by > 0)

    out = {"ts": t}
    for name, f in (("gen_tps", "generation_tokens"), ("prompt_tps", "prompt_tokens")):
        out[name], out[f"{name}_avg"] = over(f, t - t[old], old), over(f, t - t[first], first)
    for name, base in (("kv_hit", old), ("kv_hit_avg", first)):
        out[name] = over("cache_hits", value["cache_queries"] - value["cache_queries"][base], base)
    out |= {f: value[f] for f in ("running", "waiting", "kv_usage")}
    need = np.zeros(n, bool)
    if n:
        need[[first[-1], *range(old[-1], n)]] = True
        for f in MONOTONIC:
            filled = np.flatnonzero(~np.isnan(value[f][first[-1] :]))
            need[first[-1] + filled[-1:]] = True
    return pd.DataFrame(out).astype(object).where(lambda x: x.notna(), None), need


def window_sums(samples: DataFrame, seconds: int = 300, stretch: int = 3600) -> DataFrame:
    """Adds ``window_sum``: of each ``key`` the sum of ``value`` over the last seconds, the row's own and all of its time included (in: ``ts, key,
    value``). A key's rows are cut into stretches; the last seconds of one stand before the next one too."""
    wide = max(stretch, seconds) * 1_000_000
    cut = samples.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn("_b", F.floor(F.col("_t") / wide)).withColumn("_own", F.lit(True))
    late = cut.where(F.col("_t") >= (F.col("_b") + 1) * wide - seconds * 1_000_000).withColumn("_b", F.col("_b") + 1).withColumn("_own", F.lit(False))
    w = Window.partitionBy("key", "_b").orderBy("_t").rangeBetween(-seconds * 1_000_000, 0)
    return cut.unionByName(late).withColumn("window_sum", F.round(F.sum("value").over(w), 6)).where("_own").drop("_t", "_b", "_own")


def totals_and_rates(samples: DataFrame, seconds: float) -> DataFrame:
    """``key, total, per_second``; null for no elapsed time."""
    t = samples.groupBy("key").agg(F.round(F.sum("value"), 6).alias("total"))
    return t.withColumn("per_second", F.round(F.try_divide(F.col("total"), F.lit(float(seconds))), 6))


def worker_states(events: DataFrame, states: list[str]) -> DataFrame:
    """One row a worker, one count a state (in: ``worker, state``)."""
    return events.groupBy("worker").pivot("state", states).count().fillna(0, states)
