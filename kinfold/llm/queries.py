"""The queries of the ten operators and of the pipeline, and the SQL that must agree with them."""

from __future__ import annotations

import corpus_pipeline
from kinfold.llm import bpe, imatch, licenses, lines, mixing, pseudo_lm, setsketch, sharding, toxicity, vectors

QUERIES = {
    "op1_multi_index": vectors.op1_multi_index,
    "op2_jump_shards": sharding.op2_jump_shards,
    "op3_prefix_bpe": bpe.op3_prefix_bpe,
    "op4_levelled_line_dedup": lines.op4_levelled_line_dedup,
    "op5_setsketch": setsketch.op5_setsketch,
    "op6_string_kernel": toxicity.op6_string_kernel,
    "op7_imatch": imatch.op7_imatch,
    "op8_splitting_tree_mix": mixing.op8_splitting_tree_mix,
    "op9_pseudo_likelihood": pseudo_lm.op9_pseudo_likelihood,
    "op10_license_scan": licenses.op10_license_scan,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op1_multi_index": vectors.OP1_SQL,
    "op2_jump_shards": sharding.OP2_SQL,
    "op4_levelled_line_dedup": lines.OP4_SQL,
    "op5_setsketch": setsketch.OP5_SQL,
    "op7_imatch": imatch.OP7_SQL,
    "op8_splitting_tree_mix": mixing.OP8_SQL,
    "op10_license_scan": licenses.OP10_SQL,
}
