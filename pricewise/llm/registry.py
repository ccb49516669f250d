"""Queries of the llm operators, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from .decontamination import op5_benchmark_decontamination
from .license_scan import OP8_SQL, op8_license_scan
from .line_dedup import OP4_SQL, op4_line_dedup
from .ngram_join import OP7_SQL, op7_ngram_join
from .packing import op6_best_fit_packing
from .periodic_runs import OP12_SQL, op12_periodic_runs
from .quality_classifier import op10_quality_classifier
from .quality_rules import OP3_SQL, op3_quality_rules
from .substring_dedup import OP9_SQL, op9_substring_dedup
from .suffix_dedup import OP2_SQL, op2_suffix_dedup
from .token_alignment import op11_token_alignment
from .toxicity import op13_toxicity
from .warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_ngram_join": op7_ngram_join,
    "op8_license_scan": op8_license_scan,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_toxicity": op13_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op2_suffix_dedup": OP2_SQL,
    "op3_quality_rules": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op7_ngram_join": OP7_SQL,
    "op8_license_scan": OP8_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op12_periodic_runs": OP12_SQL,
}
