"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("quality", "simhash", "suffix", "trie_tokens", "lm", "mixing", "forest", "urls", "licenses", "bpe", "topk", "gnat", "merkle")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"tablewright.llm.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
