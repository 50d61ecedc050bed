"""The queries of this subpackage, and DuckDB SQL for those that SQL expresses."""

from __future__ import annotations

from .ball_tree import OP2_SQL, op2_exact_top_k
from .bpe import op4_byte_bpe
from .byte_cnn import op8_quality
from .decontamination import op10_benchmark_decontamination
from .license_scan import op3_license_scan
from .nb_linear import op7_toxicity
from .ngram_join import op6_ngram_join
from .ppm import op5_lm_score
from .substring_dedup import op1_substring_dedup
from .url_filter import OP9_SQL, op9_url_filter

QUERIES = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_exact_top_k, op3_license_scan, op4_byte_bpe, op5_lm_score, op6_ngram_join, op7_toxicity, op8_quality, op9_url_filter, op10_benchmark_decontamination)
}
ORACLES = {"op2_exact_top_k": OP2_SQL, "op9_url_filter": OP9_SQL}
