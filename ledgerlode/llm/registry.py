"""The operators' queries and SQL, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from ledgerlode.llm import ann, bpe, decontam, html_blocks, langid, neardup, pii, quality, secret_scan, token_store

MODULES = [token_store, pii, langid, neardup, ann, bpe, decontam, quality, html_blocks, secret_scan]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.ORACLE.items()}
