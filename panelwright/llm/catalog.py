"""The queries of this package and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = {
    "op1_subword_lattice": "subword_lattice",
    "op2_exact_dedup": "block_naming",
    "op3_prefix_forest": "prefix_forest",
    "op4_mixing": "mixing",
    "op5_best_fit_packing": "packing",
    "op6_token_files": "token_files",
    "op7_minhash": "minhash",
    "op8_cotraining": "cotraining",
    "op9_sentence_spans": "sentence_spans",
    "op10_suffix_arrays": "suffix_arrays",
    "op11_relational_phrases": "relational_phrases",
    "op12_filter_audit": "filter_audit",
    "op13_contextual_pii": "contextual_pii",
}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _name, _module in MODULES.items():
    _found = importlib.import_module(f"panelwright.llm.{_module}")
    QUERIES[_name] = _found.query
    if getattr(_found, "SQL", None):
        ORACLES[_name] = _found.SQL
