"""The registered queries of this folder and their SQL, where SQL can say them."""
from __future__ import annotations

from . import bpe_automaton, decontamination, parity_join, quality_rules, sharding, site_quality, substring_dedup, token_output, token_rollup, toxicity

MODULES = [toxicity, parity_join, sharding, token_rollup, token_output, bpe_automaton, decontamination, site_quality, substring_dedup, quality_rules]


def queries() -> dict:
    return {m.NAME: m.query for m in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.ORACLE for m in MODULES if m.ORACLE}
