import hashlib
import io
import random
import re
import tarfile
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagewright.operators import corpus, layout, perplexity as pp, telemetry as tl
from pagewright.sources import inputs, sinks


def test_filter(spark):
    long = "Plain words of a report that nobody reads twice. " * 6
    rows = [(1, "short", "fr"), (2, long, "fr"), (3, long, "en"), (4, long + " download free pdf ebook", "en"), (5, "1 2 3 " * 60, "fr"), (6, None, "en"), (7, long, None), (8, "", None)]
    d = spark.createDataFrame(rows, "id int, text string, lang string").select("id", corpus.filter_reason(F.col("text"), F.col("lang")).alias("r"))
    assert {x.id: x.r for x in d.collect()} == {1: None, 2: "language", 3: None, 4: "spam", 5: None, 6: "unreadable", 7: None, 8: None}


def test_work_groups(spark):
    paths = spark.createDataFrame([(f"p{i}",) for i in (3, 1, 2, 5, 4, 1)], "path string")
    g = corpus.work_groups(paths, 2)
    got = sorted(r.paths for r in g.collect())
    assert got == [["p1", "p2"], ["p3", "p4"], ["p5"]]
    assert {r.hash for r in g.collect()} == {hashlib.sha1("".join(x).encode()).hexdigest() for x in got}
    assert corpus.work_groups(paths, 2, g).count() == 0 and corpus.remaining_work(g, g.limit(1), None).count() == 2
    assert corpus.items_per_group(spark.createDataFrame([("a", 10), ("b", 30)], "path string, pages int"), 100) == 5


def test_reports(spark):
    s = corpus.workspace_stats(spark.createDataFrame([(10, 1, 5, 40000), (2, None, None, 10)], "pages int, fallback_pages int, input_tokens int, output_tokens int")).first()
    assert (s.docs, s.pages, s.fallback_pages, s.output_tokens, s.long_docs, s.long_tokens, s.pages_per_doc) == (2, 12, 1, 40010, 1, 40000, 6.0)
    assert corpus.workspace_stats(spark.createDataFrame([], "pages int, fallback_pages int, input_tokens int, output_tokens int")).first().tokens_per_page == 0
    k = spark.createDataFrame([(x,) for x in "aaabbcdde"], "kind string")
    assert [tuple(r) for r in corpus.top_rejects(k).collect()] == [("a", 3), ("b", 2), ("d", 2), ("+more", 2)]
    c = spark.createDataFrame([("finished_on_attempt_0", 5), ("finished_on_attempt_2", 3), ("finished_on_parallel_retry", 1), ("finished_on_attempt_x", 9), ("completed_pages", 3), ("failed_pages", 1)], "key string, value int")
    assert corpus.count_retries(c).first().retries == 4 and corpus.final_summary(c).first().failure_percent == 25.0


def greedy(pages, cap):
    out, used, chunk = {}, 0, 0
    for n, t in pages:
        if used and (used + len(t) + 1) // 3 > cap:
            chunk, used = chunk + 1, 0
        out[n] = (chunk, used)
        used += len(t) + 1
    return out


def test_chunks_and_attribution(spark):
    rng = random.Random(1)
    docs = {d: [(i, "x" * rng.randint(1, 90)) for i in range(1, 12)] for d in "ab"}
    p = spark.createDataFrame([(d, i, t) for d, ps in docs.items() for i, t in ps], "doc string, page int, text string")
    chunks = pp.token_chunks(p, ["doc"], 40)
    got = {(r.doc, r.page): (r.chunk, r.start) for r in chunks.collect()}
    assert got == {(d, i): v for d, ps in docs.items() for i, v in greedy(ps, 40).items()}
    two = spark.createDataFrame([("d", 1, "hello"), ("d", 2, "world")], "doc string, page int, text string")
    tokens = spark.createDataFrame([("d", 0, 0, None, None), ("d", 0, 1, "lo\nw", -1.0), ("d", 0, 2, "orld", -3.0)], "doc string, chunk int, pos int, decoded string, logprob double")
    a = {r.page: (r.n_tokens, r.sum_logprob) for r in pp.attribute_tokens(tokens, pp.token_chunks(two, ["doc"]), two, ["doc"]).collect()}
    assert a == {1: (1, -1.0), 2: (1, -3.0)}


def test_work_index(spark):
    names = ["a.pdf", 'b,"c".pdf', "d\ne.pdf", "f.pdf"]
    paths = spark.createDataFrame([(n,) for n in names], "path string")
    index = corpus.extended_index(spark.createDataFrame([], "hash string, paths array<string>"), paths.where("path < 'd'"), 2)
    more = corpus.extended_index(index, paths, 2)
    assert more.count() == 2 and corpus.extended_index(more, paths, 3).count() == 2 and {x for r in more.collect() for x in r.paths} == set(names)
    lines = corpus.index_lines(more)
    assert sorted(map(str, corpus.read_index(lines.union(spark.createDataFrame([("  ",)], "line string"))).collect())) == sorted(map(str, more.select("hash", "paths").collect()))
    many = spark.createDataFrame([(f"h{i}", [f"p{i}"]) for i in range(30)], "hash string, paths array<string>")
    order = lambda s: [r.hash for r in corpus.shuffled(many, s).collect()]
    assert order(1) == order(1) != order(2) and sorted(order(1)) == sorted(r.hash for r in many.collect())


METRICS = """# HELP x
vllm:num_requests_running{engine="0"} 5
vllm:num_requests_running{engine="1"} 3
vllm:kv_cache_usage_perc{engine="0"} 0.4
vllm:kv_cache_usage_perc{engine="1"} 0.6
vllm:prompt_tokens_total{engine="0"} 1000
vllm:prompt_tokens_created{engine="0"} 7
vllm:generation_tokens_total NaN
not a metric line
"""


def test_telemetry(spark):
    s = tl.snapshots(spark.createDataFrame([(METRICS,), ("",)], "text string")).collect()
    assert (s[0].running, s[0].kv_usage, s[0].prompt_tokens, s[0].cache_queries, s[0].generation_tokens, s[0].waiting) == (8.0, 0.5, 1000.0, 1000.0, None, None) and s[1].running is None
    rows = [("s", 0.0, 0.0, 10.0), ("s", 10.0, 500.0, None), ("s", 20.0, 1000.0, 5.0), ("s", 30.0, 1500.0, 15.0)]
    r = [(x.gen_tps, x.gen_tps_avg) for x in tl.counter_rates(spark.createDataFrame(rows, "server string, ts double, generation_tokens double, prompt_tokens double")).orderBy("ts").collect()]
    assert r == [(None, None), (50.0, 50.0), (None, None), (50.0, 50.0)]
    one, need = tl.frame_rates(pd.DataFrame({"ts": range(0, 200, 10), "generation_tokens": range(0, 200, 10)}, dtype=float), 60)
    assert need.sum() == 8 and one["gen_tps"].tolist()[1:] == [1.0] * 19


def plain_rates(samples, window):
    """By definition: each sample against the oldest in its window and the first of its segment."""
    out, begin = [], 0
    for i, (t, gen, prompt) in enumerate(samples):
        for k in (1, 2):
            before = [s[k] for s in samples[begin:i] if s[k] is not None]
            if before and samples[i][k] is not None and samples[i][k] < before[-1]:
                begin = i
        inside = [s for s in samples[begin : i + 1] if s[0] >= t - window]
        old = inside[0] if len(inside) > 1 else samples[max(begin, i - 1)]
        rate = lambda k, a: None if t == a[0] or samples[i][k] is None or a[k] is None else (samples[i][k] - a[k]) / (t - a[0])
        out.append((float(t), rate(1, old), rate(1, samples[begin]), rate(2, old), rate(2, samples[begin])))
    return out


def test_rates_match_their_definition(spark):
    rng, rows, want = random.Random(8), [], {}
    for server in ("a", "b", None):
        t, gen, prompt, samples = 0, 0.0, 0.0, []
        for _ in range(150):
            t += rng.choice([5, 10, 40, 90])
            if rng.random() < 0.08:
                gen, prompt = 0.0, 0.0
            gen, prompt = gen + rng.randint(0, 50), prompt + rng.randint(0, 9)
            samples.append((t, gen if rng.random() < 0.7 else None, prompt if rng.random() < 0.7 else None))
        want[server] = plain_rates(samples, 60)
        rows += [(server, float(a), b, c, "extra") for a, b, c in samples]
    df = spark.createDataFrame(rows, "server string, ts double, generation_tokens double, prompt_tokens double, more string")
    for stretch in (60.0, 1e6):  # many stretches, one stretch
        got = {}
        for r in tl.counter_rates(df, stretch=stretch).orderBy("ts").collect():
            got.setdefault(r.server, []).append((r.ts, r.gen_tps, r.gen_tps_avg, r.prompt_tps, r.prompt_tps_avg))
        assert got == want
    frames = {s: tl.frame_rates(pd.DataFrame([r[1:4] for r in rows if r[0] == s], columns=["ts", "generation_tokens", "prompt_tokens"]).astype(float), 60)[0] for s in ("a", "b")}
    for s, f in frames.items():
        assert list(f[["ts", "gen_tps", "gen_tps_avg", "prompt_tps", "prompt_tps_avg"]].itertuples(index=False, name=None)) == want[s]
    assert tl.counter_rates(df.limit(0)).count() == 0


def test_window_sums_do_not_depend_on_stretches(spark):
    rows = [(i, datetime.fromtimestamp(1_700_000_000 + i * 37 % 20_000), "ab"[i % 2], float(i)) for i in range(800)]
    df = spark.createDataFrame(rows, "i int, ts timestamp, key string, value double")
    one, many = ({r.i: r.window_sum for r in tl.window_sums(df, 300, s).collect()} for s in (10**8, 300))
    assert one == many and len(one) == 800


def test_one_warning_an_outage_and_sliding_sums(spark, tmp_path):
    from pagewright.streaming import counters as cs

    rows = [("s", float(t), t not in (3, 4, 5, 9)) for t in range(12)]
    spark.createDataFrame(rows, "server string, ts double, available boolean").coalesce(1).write.json(str(tmp_path / "in"))
    got = []
    cs.drain(cs.outages(spark.readStream.schema("server string, ts double, available boolean").json(str(tmp_path / "in"))), lambda b, n: got.extend(map(tuple, b.collect())), str(tmp_path / "cp"))
    assert got == [("s", 3.0), ("s", 9.0)]
    s = spark.createDataFrame([(datetime(2025, 1, 1, 0, 4, 30), "k", 1.0), (datetime(2025, 1, 1, 0, 6, 30), "k", 2.0)], "ts timestamp, key string, value double")
    assert cs.windowed_counters(s).agg(F.max("total")).first()[0] == 3.0 and cs.windowed_counters(s, slide=None).agg(F.max("total")).first()[0] == 2.0


def test_stream_equals_batch(spark, tmp_path):
    from pagewright.streaming import counters as cs

    rows = [("s", float(t), float(t * t % 97)) for t in range(30)] + [("r", float(t), float(t)) for t in range(5)]
    df = spark.createDataFrame(rows, "server string, ts double, generation_tokens double")
    batch = sorted(map(tuple, tl.counter_rates(df).collect()), key=str)
    got = []
    for i, part in enumerate((df.where("ts < 11"), df.where("ts >= 11 and ts < 20"), df.where("ts >= 20"))):
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = cs.rate_stream(spark.readStream.schema(df.schema).json(str(tmp_path / "in")))
        cs.drain(stream, lambda b, n: got.extend(map(tuple, b.collect())), str(tmp_path / "cp"))
    assert sorted(got, key=str) == batch


def test_layout(spark):
    boxes = [("a", 0, 0, 10, 10), ("b", 10.4, 0, 20, 10), ("c", 50, 50, 60, 60), ("d", 20.2, 5, 30, 10)]
    assert layout.merge_boxes(boxes) == [("a+b+d", 0, 0, 30, 10), ("c", 50, 50, 60, 60)]
    lines = [(f"line {i} [x]", 10.0, float(i)) for i in range(200)] + [(" ", 0.0, 0.0), ("caf\u00c3\u00a9\tbar", 5.0, 300.0)]
    places = [(b[0], *map(float, b[1:])) for b in boxes]
    page = spark.createDataFrame([(1, 100.0, 200.0, lines[:2], places), (2, 100.0, 200.0, lines, places), (3, 1.0, 2.0, None, None)],
                                 "id int, width double, height double, texts array<struct<text:string,x:double,y:double>>, images array<struct<name:string,x0:double,y0:double,x1:double,y1:double>>")
    full = {r.id: r.report for r in layout.page_reports(page).collect()}
    assert full[1] == "Page dimensions: 100.0x200.0\n[Image 0x0 to 30x10]\n[Image 50x50 to 60x60]\n[10x0]line 0 \\[x\\]\n[10x1]line 1 \\[x\\]\n" and full[3] == "Page dimensions: 1.0x2.0\n"
    short = {r.id: r.report for r in layout.page_reports(page, 500).collect()}
    assert 400 < len(short[2]) <= 500 and "[5x300]caf\u00e9\\tbar\n" in short[2] and "[10x0]line 0" in short[2] and "[Image 0x0 to 30x10]" in short[2]
    xs = [tuple(map(float, re.match(r"\[(?:Image )?(\d+)x(\d+)", x).groups())) for x in short[2].split("\n")[1:-1]]
    assert xs == sorted(xs) and layout.page_reports(page, 500, 1).where("id = 2").first().report != short[2]
    assert layout.page_reports(page, 10).where("id = 3").first().report == "Page dimensions: 1.0x2.0\n" and layout.page_reports(page, -1).where("id = 3").first().report.endswith("[Image 0x0 to 1x2]\n")
    long = spark.createDataFrame([("a" * 300,), ("word " * 80,), ("short",)], "t string").select(layout.capped(F.col("t")).alias("c")).collect()
    assert long[0].c == "a" * 122 + " ... " + "a" * 122 and long[1].c.startswith("word word") and " word ... " in long[1].c and len(long[1].c) < 250 and long[2].c == "short"
    r = spark.range(1).select(layout.compose(F.array(*[F.lit(float(x)) for x in (2, 0, 0, 3, 1, 1)]), F.array(*[F.lit(float(x)) for x in (1, 0, 0, 1, 5, 6)])).alias("m")).select("m", layout.transform(F.col("m"), F.lit(1.0), F.lit(1.0)).alias("p")).first()
    assert r.m == [2, 0, 0, 3, 6, 7] and tuple(r.p) == (8, 10)


def test_bands_lose_no_pair(spark):
    rng = random.Random(3)
    rows = [(i % 2, i, x := rng.uniform(0, 900), y := rng.uniform(-50, 900), x + rng.uniform(0, 90), y + rng.uniform(0, 300)) for i in range(160)]
    df = spark.createDataFrame(rows + [(None, 900, 0.0, 0.0, 1.0, 1.0), (0, 901, None, 0.0, 1.0, 1.0)], "page int, id int, x0 double, y0 double, x1 double, y1 double")
    near = lambda a, b: a[0] == b[0] and max(a[2], b[2]) - min(a[4], b[4]) <= 0.5 and max(a[3], b[3]) - min(a[5], b[5]) <= 0.5
    want = sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[1] < b[1] and near(a, b))
    assert sorted(map(tuple, layout.overlapping(df, ["page"]).collect())) == want


def test_inputs(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "b.png").write_bytes(b"nope")
    (tmp_path / "c.txt").write_text("x.pdf\n\ny.tgz\n")
    with pytest.warns(UserWarning):
        papers, tars = inputs.expand_inputs(spark, [str(tmp_path / "*.p*"), str(tmp_path / "c.txt")])
    assert papers == {str(tmp_path / "a.pdf"), "x.pdf"} and tars == {"y.tgz"}
    with pytest.raises(ValueError):
        inputs.expand_inputs(spark, [str(tmp_path / "none.pdf")])
    assert inputs.parse_run_specs([" a =p=q"]) == [("a", "p=q")]
    for bad in (["a"], ["=p"], ["a=p", "a=q"]):
        with pytest.raises(ValueError):
            inputs.parse_run_specs(bad)
    (tmp_path / "r.jsonl").write_text('{"text": "t", "metadata": {"Source-File": "/x/y.pdf"}}\nbroken\n\n{"text": "u"}\n')
    d = inputs.read_documents(spark, inputs.run_files(spark, str(tmp_path)), strict=False)
    assert [r.text for r in d.collect()] == ["t"] and sinks.write_markdown(d, str(tmp_path / "out")) == 1 and (tmp_path / "out/markdown/x/y.md").read_text() == "t"
    with pytest.raises(Exception):
        inputs.read_documents(spark, inputs.run_files(spark, str(tmp_path))).collect()
    (tmp_path / "w.txt").write_text("One two\ntwo")
    assert {r.word for r in inputs.read_words(spark, [str(tmp_path / "w.txt")]).collect()} == {"one", "two"}


def test_tarballs_are_streamed(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        for name, data in (("in/x.pdf", b"%PDF-1 x" * 1000), ("in/y.txt", b"no"), ("z.PDF", b"%PDF-2")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    path = str(tmp_path / "a.tar.gz")
    for given in (path, f"file://{path}"):
        got = {r.source: (r.name, len(r.content)) for r in inputs.tarball_members(spark, [given]).collect()}
        assert got == {f"{path}::in/x.pdf": ("x.pdf", 8000), f"{path}::z.PDF": ("z.PDF", 6)}
    assert inputs.tarball_members(spark, []).count() == 0
    assert inputs.Files(spark).find(f"file://{tmp_path}/*.gz") == [f"file:{path}"]
