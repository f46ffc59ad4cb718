"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from adtrail.llm.benchmark_index import OP9_SQL, op9_benchmark_index
from adtrail.llm.best_fit_packing import op3_best_fit_packing
from adtrail.llm.language_profiles import op4_language_profiles
from adtrail.llm.lexical_search import OP11_SQL, op11_lexical_search
from adtrail.llm.license_scan import OP1_SQL, op1_license_scan
from adtrail.llm.line_dedup import op7_line_dedup
from adtrail.llm.merkle_fingerprints import op5_merkle_fingerprints
from adtrail.llm.ngram_join import OP8_SQL, op8_ngram_join
from adtrail.llm.phrase_mining import OP13_SQL, op13_phrase_mining
from adtrail.llm.prefix_counts import op12_token_counts
from adtrail.llm.suffix_dedup import OP2_SQL, op2_suffix_dedup
from adtrail.llm.token_files import op6_token_files
from adtrail.llm.url_templates import OP10_SQL, op10_url_templates

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_profiles": op4_language_profiles,
    "op5_merkle_fingerprints": op5_merkle_fingerprints,
    "op6_token_files": op6_token_files,
    "op7_line_dedup": op7_line_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_benchmark_index": op9_benchmark_index,
    "op10_url_templates": op10_url_templates,
    "op11_lexical_search": op11_lexical_search,
    "op12_token_counts": op12_token_counts,
    "op13_phrase_mining": op13_phrase_mining,
}

ORACLE_SQL = {
    "op1_license_scan": OP1_SQL,
    "op2_suffix_dedup": OP2_SQL,
    "op8_ngram_join": OP8_SQL,
    "op9_benchmark_index": OP9_SQL,
    "op10_url_templates": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_phrase_mining": OP13_SQL,
}
