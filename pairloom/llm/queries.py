"""Registered queries of the training-data operators and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm.decontaminate import op7_latent_semantic_decontamination
from pairloom.llm.jaccard import op10_grouped_prefix_join
from pairloom.llm.language import op8_language_mixture
from pairloom.llm.line_templates import op2_line_templates
from pairloom.llm.nearest import op4_block_matrix_neighbours
from pairloom.llm.packing import op5_best_fit_packing
from pairloom.llm.pii import op6_word_shape_field
from pairloom.llm.piecewise import op13_context_triggered_hashes
from pairloom.llm.resampling import op12_median_of_medians_resampling
from pairloom.llm.scoring import op9_log_bilinear_scores
from pairloom.llm.sharding import op3_hilbert_sharding
from pairloom.llm.spelling import op11_frequency_vector_trie
from pairloom.llm.toxicity import op1_gated_recurrent_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_gated_recurrent_toxicity": op1_gated_recurrent_toxicity,
    "op2_line_templates": op2_line_templates,
    "op3_hilbert_sharding": op3_hilbert_sharding,
    "op4_block_matrix_neighbours": op4_block_matrix_neighbours,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_word_shape_field": op6_word_shape_field,
    "op7_latent_semantic_decontamination": op7_latent_semantic_decontamination,
    "op8_language_mixture": op8_language_mixture,
    "op9_log_bilinear_scores": op9_log_bilinear_scores,
    "op10_grouped_prefix_join": op10_grouped_prefix_join,
    "op11_frequency_vector_trie": op11_frequency_vector_trie,
    "op12_median_of_medians_resampling": op12_median_of_medians_resampling,
    "op13_context_triggered_hashes": op13_context_triggered_hashes,
}

NEIGHBOURS = """
WITH usable AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), asked AS (SELECT vec_id, min(v) AS v FROM usable WHERE vec_id % 20 = 0 GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id AS vec_id, list_inner_product(q.v, r.v) AS score
    FROM asked q JOIN usable r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

ORACLES: dict[str, str] = {"op4_block_matrix_neighbours": NEIGHBOURS}
