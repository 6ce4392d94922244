"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quillmesh.llm import brown, decontaminate, divergence, exact_dedup, importance, language, packing, quality, sharding, sketch_join, substrings, url_filter, warc

MODULES = [brown, packing, exact_dedup, sketch_join, sharding, substrings, warc, language, quality, decontaminate, url_filter, importance, divergence]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
