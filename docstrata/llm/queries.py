"""The registered queries of this folder and the SQL that some of them must agree with."""

from __future__ import annotations

from docstrata.llm.checks import OP1, OP4, OP10, OP12, OP13
from docstrata.llm.decontaminate import op1_template_windows
from docstrata.llm.embeddings import op10_cap_filters
from docstrata.llm.hard_negatives import op13_hard_negatives
from docstrata.llm.langid import op8_rank_profiles
from docstrata.llm.licenses import op3_license_notices
from docstrata.llm.packing import op2_concat_and_cut
from docstrata.llm.passages import op6_compact_windows
from docstrata.llm.prefix_trie import op12_prefix_trie
from docstrata.llm.quality import op7_byte_cnn
from docstrata.llm.secrets import op9_structural_secrets
from docstrata.llm.simhash import op5_popcount_grid
from docstrata.llm.suffix_dedup import op4_previous_factors
from docstrata.llm.token_files import op11_token_files

QUERIES = {f.__name__: f for f in (op1_template_windows, op2_concat_and_cut, op3_license_notices, op4_previous_factors, op5_popcount_grid, op6_compact_windows, op7_byte_cnn, op8_rank_profiles, op9_structural_secrets, op10_cap_filters, op11_token_files, op12_prefix_trie, op13_hard_negatives)}
CHECKS: dict[str, str] = {"op1_template_windows": OP1, "op4_previous_factors": OP4, "op10_cap_filters": OP10, "op12_prefix_trie": OP12, "op13_hard_negatives": OP13}
