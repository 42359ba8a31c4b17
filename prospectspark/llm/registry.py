"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .exact_dedup import OP10_SQL, op10_exact_dedup
from .licenses import OP3_SQL, op3_license_scan
from .line_dedup import OP9_EVERY_LINE_SQL, OP9_SQL, op9_line_dedup, op9_line_dedup_every_line
from .minhash import OP6_SQL, op6_minhash_near_dedup
from .mixing import OP1_SQL, op1_source_mixing
from .packing import op8_best_fit_packing
from .pieces import op13_sentencepiece
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .quality import OP7_SQL, op7_quality_rules
from .substring_dedup import OP5_SQL, op5_substring_dedup
from .suffix_dedup import op2_suffix_dedup
from .url_filter import OP4_SQL, op4_url_filter
from .variants import OP11_SQL, op11_spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_url_filter": op4_url_filter,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op9_line_dedup_every_line": op9_line_dedup_every_line,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL: dict[str, str] = {
    "op1_source_mixing": OP1_SQL,
    "op3_license_scan": OP3_SQL,
    "op4_url_filter": OP4_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op6_minhash_near_dedup": OP6_SQL,
    "op7_quality_rules": OP7_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op9_line_dedup_every_line": OP9_EVERY_LINE_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}
