"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (bpe_codec, fingerprints, jaccard, language, packing, passages, pii, positive_unlabelled, quality, ranked_search,
                          repair, url_rules, whitening)
from tidemark.llm.shipping import ship
from tidemark.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(tune(spark))
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {q.__name__: _ready(q) for q in (
    quality.op1_quality_llr, repair.op2_repair_ids, passages.op3_phrase_automata, language.op4_crf_language, jaccard.op5_trie_jaccard,
    packing.op6_best_fit_packing,
    fingerprints.op7_weighted_sampling, pii.op8_pii_spans, bpe_codec.op9_bpe_codec, url_rules.op10_url_rules,
    whitening.op11_spectrum_whitening, positive_unlabelled.op12_pu_quality, ranked_search.op13_k2_treap_search)}
SQL: dict[str, str] = {"op3_phrase_automata": passages.OP3_SQL, "op5_trie_jaccard": jaccard.OP5_SQL,
                       "op13_k2_treap_search": ranked_search.OP13_SQL}
