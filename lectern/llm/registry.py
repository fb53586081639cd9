"""The queries of the training-data operators, and their SQL."""

from __future__ import annotations

from lectern.llm.decontaminate import OP9_SQL, op9_decontaminate
from lectern.llm.exact_dedup import OP12_SQL, op12_exact_dedup
from lectern.llm.line_dedup import op2_line_dedup
from lectern.llm.manifest import OP11_SQL, op11_manifest
from lectern.llm.minhash import op7_near_duplicates
from lectern.llm.packing import op1_pack
from lectern.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from lectern.llm.quality import op8_quality
from lectern.llm.quality_rules import OP3_SQL, op3_quality_rules
from lectern.llm.substring import OP4_SQL, op4_substring_dedup
from lectern.llm.token_files import op10_token_files
from lectern.llm.url_filter import OP6_SQL, op6_url_filter
from lectern.llm.warc import OP5_SQL, op5_fixity

QUERIES = {f.__name__: f for f in (op1_pack, op2_line_dedup, op3_quality_rules, op4_substring_dedup, op5_fixity, op6_url_filter, op7_near_duplicates, op8_quality, op9_decontaminate, op10_token_files, op11_manifest, op12_exact_dedup, op13_prefix_trie)}
SQL = {"op3_quality_rules": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op5_fixity": OP5_SQL, "op6_url_filter": OP6_SQL, "op9_decontaminate": OP9_SQL, "op11_manifest": OP11_SQL, "op12_exact_dedup": OP12_SQL, "op13_prefix_trie": OP13_SQL}
