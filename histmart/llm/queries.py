"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can express them."""

from __future__ import annotations

from histmart.llm import alignment, chat, decontaminate, exactdup, hmm, nearjoin, packing, passages, pii, quality, sharding, sourceaudit, urlgraph
from histmart.llm.common import table


def _on(name: str, fn):
    def run(spark, sf_dir):
        return fn(table(spark, sf_dir, name))
    return run


QUERIES = {
    "op1_adaptive_quality": _on("documents", quality.op1_query),
    "op2_harmonic_packing": _on("documents", packing.op2_query),
    "op3_hidden_markov": _on("documents", hmm.op3_query),
    "op4_link_trust": _on("pages", urlgraph.op4_query),
    "op5_fm_index": lambda spark, sf_dir: decontaminate.op5_query(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op6_bayes_jaccard": _on("documents", nearjoin.op6_query),
    "op7_feistel_pseudonyms": _on("documents", pii.op7_query),
    "op8_collinear_passages": _on("documents", passages.op8_query),
    "op9_external_shuffle": _on("documents", sharding.op9_query),
    "op10_prefix_target": _on("conversations", chat.op10_query),
    "op11_token_alignment": _on("documents", alignment.op11_query),
    "op12_patricia_owners": _on("documents", exactdup.op12_query),
    "op13_source_audit": _on("documents", sourceaudit.op13_query),
}

ORACLES = {
    "op1_adaptive_quality": quality.ORACLE,
    "op10_prefix_target": chat.ORACLE,
    "op12_patricia_owners": exactdup.ORACLE,
    "op13_source_audit": sourceaudit.ORACLE,
}
