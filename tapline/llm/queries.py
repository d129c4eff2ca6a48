"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tapline.llm.byte_bpe import op4_byte_bpe
from tapline.llm.decontaminate import op9_decontamination
from tapline.llm.language import op2_language
from tapline.llm.line_dedup import op8_line_dedup
from tapline.llm.line_rules import SQL as RULES_SQL
from tapline.llm.line_rules import op10_quality_rules
from tapline.llm.packing import op11_best_two_fit
from tapline.llm.passages import op5_passages
from tapline.llm.pii import op3_pii
from tapline.llm.quality import op7_quality
from tapline.llm.search import SQL as SEARCH_SQL
from tapline.llm.search import op13_ranked_search
from tapline.llm.sharding import op1_kd_shards
from tapline.llm.simhash import op6_simhash
from tapline.llm.turn_trie import SQL as TRIE_SQL
from tapline.llm.turn_trie import op12_turn_trie

QUERIES = {
    "op1_kd_shards": op1_kd_shards,
    "op2_language": op2_language,
    "op3_pii": op3_pii,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_passages": op5_passages,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_best_two_fit": op11_best_two_fit,
    "op12_turn_trie": op12_turn_trie,
    "op13_ranked_search": op13_ranked_search,
}
SQL = {"op10_quality_rules": RULES_SQL, "op12_turn_trie": TRIE_SQL, "op13_ranked_search": SEARCH_SQL}
