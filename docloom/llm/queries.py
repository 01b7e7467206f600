"""The queries of this subpackage and, where DuckDB can express them, their SQL."""

from __future__ import annotations

from .chunk_dedup import op1_chunk_dedup
from .decontamination import op3_decontamination
from .html_extract import op6_html_extract
from .jaccard_join import op9_jaccard_join
from .kneser_ney import op7_kneser_ney
from .line_dedup import OP5_SQL, op5_line_dedup
from .packing import op4_packing
from .quality_rules import OP2_SQL, op2_quality_rules
from .secret_scan import OP10_SQL, op10_secret_scan
from .spelling_variants import OP12_SQL, op12_spelling_variants
from .suffix_dedup import op8_suffix_dedup
from .token_counts import op11_token_counts
from .whitening import op13_whitening

QUERIES = {
    "op1_chunk_dedup": op1_chunk_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL = {
    "op2_quality_rules": OP2_SQL,
    "op5_line_dedup": OP5_SQL,
    "op10_secret_scan": OP10_SQL,
    "op12_spelling_variants": OP12_SQL,
}
