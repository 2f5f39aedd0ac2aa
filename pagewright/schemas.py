"""Explicit schemas, as DDL; readers never infer."""


METADATA = "`Source-File` string, `pagewright-version` string, `pdf-total-pages` bigint, `total-input-tokens` bigint, `total-output-tokens` bigint, `total-fallback-pages` bigint"
ATTRIBUTES = "pdf_page_numbers array<array<bigint>>, primary_language array<string>, is_rotation_valid array<boolean>, rotation_correction array<int>, is_table array<boolean>, is_diagram array<boolean>"
#: One document of a run, as its JSON lines have it.
DOCUMENT = f"id string, text string, source string, added string, created string, metadata struct<{METADATA.replace(' string', ': string').replace(' bigint', ': bigint')}>, attributes struct<{', '.join(x.replace(' ', ': ', 1) for x in ATTRIBUTES.split(', '))}>"
#: One page of one run: the central fact table of an evaluation.
PAGES = "model string, doc string, page int, text string"
DOC_META = "model string, doc string, total_pages bigint, fallback_pages bigint, source_file string"
#: One answer of a model to one page.
ATTEMPTS = "doc string, page int, attempt int, status int, raw string, input_tokens bigint, output_tokens bigint, ink double"
RUNS = "model string, input_path string, pplx_scorer_model string"
METRICS = {
    "correction_rate": "model string, doc string, page int, correction_rate double, uncorrectable_rate double",
    "garbage_fraction": "model string, doc string, page int, score double",
    "peer_agreement": "model string, peer string, doc string, page int, bow_f1 double, one_minus_ned double",
    "textlayer_agreement": "model string, doc string, page int, bow_f1 double, one_minus_ned double",
    "reject_rate": "model string, doc string, fallback_pages bigint, total_pages bigint",
    "pplx": "model string, doc string, page int, n_tokens_raw double, sum_logprob_raw double, ppl_raw double, n_tokens_corrected double, sum_logprob_corrected double, ppl_corrected double",
}
LEDGER = "model string, doc string, phase string, text_sha1 string"


def names(ddl: str) -> list[str]:
    """Column names of a flat schema."""
    return [x.split()[0] for x in ddl.split(", ")]
