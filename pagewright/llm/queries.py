"""Queries of the training-text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import encoding, language, markup, mixing, packing, quality, ranking, repetition, scan, truncation


def queries():
    return {f.__name__: f for f in (
        encoding.p1_found, encoding.p1_restored, markup.p2_found, markup.p2_clean, language.p3_found, language.p3_languages,
        ranking.p4_found, ranking.p4_ranking, repetition.p5_found, repetition.p5_shares, truncation.p6_found, truncation.p6_rates,
        scan.p7_found, scan.p7_repaired, packing.p8_found, packing.p8_containers, mixing.p9_found, mixing.p9_shares, mixing.p9_mix,
        quality.p10_found, quality.p10_kinds, quality.p10_stats,
    )}


def oracle_sql():
    return {"p4_found": ranking.FOUND_SQL, "p4_ranking": ranking.RANKING_SQL, "p5_found": repetition.FOUND_SQL, "p10_stats": quality.STATS_SQL}
