"""Queries that do the whole job where SQL cannot follow, against brute force on small tables."""

import random

from pagewright.plans import queries as q


def page_table(spark, tmp_path, rows):
    spark.createDataFrame(rows, "text_id bigint, model string, doc string, page int, text string").coalesce(1).write.parquet(str(tmp_path / "page_texts.parquet"))
    return str(tmp_path)


def test_tokens_are_put_back_to_all_pages(spark, tmp_path):
    rng = random.Random(4)
    docs = {(m, d): [(i, "é" * rng.choice([0, 1, 3, 400, 1501, 3100])) for i in range(1, 14)] for m in "ab" for d in "xy"}
    rows = [(100 * i + n, m, d, n, t) for i, ((m, d), ps) in enumerate(docs.items()) for n, t in ps]
    path = page_table(spark, tmp_path, rows + rows[:9] + [(9_999, "a", "x", 20, None)])
    want, n_chunks = {}, 0
    for key, ps in docs.items():
        chunks, used = [[]], 0
        for n, t in ps:
            if used and (used + len(t) + 1) // 3 > 1000:
                chunks.append([])
                used = 0
            chunks[-1].append((n, t))
            used += len(t) + 1
        n_chunks = max(n_chunks, len(chunks))
        for c in chunks:
            owner = [n for n, t in c for _ in range(len(t) + 1)][:-1]  # whose page each character of the prompt is
            for n, _ in c:
                want[*key, n] = [0, 0.0]
            for k in range(4, len(owner), 4):
                want[*key, owner[k]][0] += 1
                want[*key, owner[k]][1] -= 0.1 * (1 + k % 7)
    got = {(r.model, r.doc, r.page): (r.n_tokens, r.sum_logprob) for r in q.QUERIES["attributed_tokens"](spark, path).collect()}
    assert n_chunks > 3 and {k: (n, round(s, 5)) for k, (n, s) in want.items()} == {k: (n, round(s, 5)) for k, (n, s) in got.items()}


def test_peers_are_compared_on_whole_texts(spark, tmp_path):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, old = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
        return row[-1]

    texts = {"a": "Школьный совет округа", "b": "Школьная смета округа", "c": "Muller résumé Łódź", "d": "Müller resume Łodz", "e": "", "f": "12"}
    path = page_table(spark, tmp_path, [(i, m, "d", 1, t) for i, (m, t) in enumerate(texts.items())] * 2 + [(90, "a", "d", 2, "x"), (91, "b", "d", 2, None)])
    got = {(r.model, r.peer): r.one_minus_ned for r in q.QUERIES["peer_agreement"](spark, path).collect()}
    want = {(m, n): round(1 - distance(a, b) / max(len(a), len(b)), 6) for m, a in texts.items() for n, b in texts.items() if m != n}
    assert got == want and 0 < got["a", "b"] < 1 and got["c", "d"] < 1


def test_top_rejects_know_loops(spark, tmp_path):
    good = "A plain text of some length with nothing wrong in it."
    texts = ["a phrase again " * 60] * 3 + ["x" * 60 + " end of it"] * 2 + ["", "ends here...", good]
    rows = [(i, "m", t, False, i) for i, t in enumerate(texts)] + [(50, "m", "a phrase again " * 60, True, 1)]
    spark.createDataFrame(rows, "response_id bigint, model string, natural_text string, is_valid boolean, ingested_at bigint").coalesce(1).write.parquet(str(tmp_path / "page_responses.parquet"))
    got = [(r.kind, r.n) for r in q.QUERIES["top_rejects"](spark, str(tmp_path)).collect()]
    assert got == [("repeated_ngram", 3), ("repeated_character", 2), ("empty_output", 1), ("+more", 2)]
