"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from merchlake.llm import (
    op01_quality,
    op02_urls,
    op03_minhash,
    op04_lines,
    op05_language,
    op06_substrings,
    op07_mixing,
    op08_fertility,
    op09_covertree,
    op10_pieces,
    op11_alignment,
    op12_search,
    op13_secrets,
)

_MODULES = (
    op01_quality,
    op02_urls,
    op03_minhash,
    op04_lines,
    op05_language,
    op06_substrings,
    op07_mixing,
    op08_fertility,
    op09_covertree,
    op10_pieces,
    op11_alignment,
    op12_search,
    op13_secrets,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
