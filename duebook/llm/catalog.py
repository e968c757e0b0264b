"""Registered queries of the training-data operators, and SQL where SQL can express them."""

import corpus_pipeline
from duebook.llm import (
    bpe, clusters, language, lines, mixing, near_dup, packing, prefix_trie, quality, repeats, sharding, topk, urls,
)


def queries():
    return {
        "op1_suffix_dedup": repeats.op1_suffix_dedup,
        "op2_quality_rules": quality.op2_quality_rules,
        "op3_minhash_dedup": near_dup.op3_minhash_dedup,
        "op4_bpe_round_trip": bpe.op4_bpe_round_trip,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_url_filter": urls.op6_url_filter,
        "op7_language_id": language.op7_language_id,
        "op8_line_dedup": lines.op8_line_dedup,
        "op9_shards": sharding.op9_shards,
        "op10_top_k": topk.op10_top_k,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_best_fit": packing.op12_best_fit,
        "op13_centroid_clusters": clusters.op13_centroid_clusters,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql():
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return pipeline | {
        "op2_quality_rules": quality.OP2_SQL,
        "op3_minhash_dedup": near_dup.OP3_SQL,
        "op5_mix_sources": mixing.OP5_SQL,
        "op6_url_filter": urls.OP6_SQL,
        "op8_line_dedup": lines.OP8_SQL,
        "op10_top_k": topk.OP10_SQL,
        "op11_prefix_trie": prefix_trie.OP11_SQL,
        "op13_centroid_clusters": clusters.OP13_SQL,
    }
