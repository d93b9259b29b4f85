"""The queries of the text operators and the SQL some of them are checked with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loginwatch.llm import bpe, classifier, decontamination, html_text, language_id, lexical, pii, quality_rules, sharding, simhash, url_filters, warc, whitening
from loginwatch.llm.common import table
from loginwatch.llm.oracle import ORACLE_SQL
from loginwatch.plans.session import shared_dir

__all__ = ["BPE_FILE", "ORACLE_SQL", "QUERIES"]

#: Where the vocabulary lies; a parameter of the operator.
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": lambda s, d: sharding.document_shards(table(s, d, "documents")),
    "op2_quality_rules": lambda s, d: quality_rules.quality_report(
        table(s, d, "documents"), table(s, d, "labels")
    ),
    "op3_simhash": lambda s, d: simhash.near_copy_classes(table(s, d, "documents")),
    "op4_bpe": lambda s, d: bpe.token_digests(table(s, d, "documents"), BPE_FILE),
    "op5_decontamination": lambda s, d: decontamination.contamination_report(
        table(s, d, "documents"), table(s, d, "benchmark")
    ),
    "op6_url_filters": lambda s, d: url_filters.url_verdicts(table(s, d, "pages")),
    "op7_warc": lambda s, d: warc.archived(table(s, d, "pages"), shared_dir(s, "warc")),
    "op8_classifier": lambda s, d: classifier.quality_scores(
        table(s, d, "documents"), table(s, d, "labels")
    ),
    "op9_pii": lambda s, d: pii.span_report(table(s, d, "documents")),
    "op10_html_text": lambda s, d: html_text.page_texts(table(s, d, "pages")),
    "op11_whitening": lambda s, d: whitening.whitened(table(s, d, "embeddings")),
    "op12_language_id": lambda s, d: language_id.language_predictions(table(s, d, "documents")),
    "op13_lexical_search": lambda s, d: lexical.ranked_documents(table(s, d, "documents"), table(s, d, "benchmark")),
}
