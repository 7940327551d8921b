"""Identifiers and digests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cik10(value: Column) -> Column:
    """Ten digits from 1 to 10 ASCII digits, with or without the prefix CIK in any case; otherwise null."""
    digits = F.regexp_extract(F.trim(value.cast("string")), r"^(?:(?i:CIK))?([0-9]{1,10})$", 1)
    return F.when(digits != "", F.lpad(digits, 10, "0"))


def is_accession(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^[0-9]{10}-[0-9]{2}-[0-9]{6}$"), F.lit(False))


def filing_id(cik: Column, accession: Column) -> Column:
    """``cik10:accession``, or null where either isn't canonical."""
    return F.when(cik.rlike("^[0-9]{10}$") & is_accession(accession), F.concat_ws(":", cik, accession))


def inventory_document_id(filing: Column, url: Column) -> Column:
    """sha256 of the canonical JSON list of a version mark, the filing and the URL."""
    return F.sha2(F.to_json(F.array(F.lit("document-v1"), filing, url)), 256)


def builder_document_id(filing: Column, name: Column) -> Column:
    """sha256 of the filing, a backslash, a zero digit and the file name."""
    return F.sha2(F.concat(filing, F.lit("\\0"), name), 256)


def content_id(*parts: Column) -> Column:
    """The first 32 hex digits of the sha256 of the parts with NUL between them; null is the empty string."""
    return F.substring(F.sha2(F.concat_ws("\x00", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256), 1, 32)


def missing(value: Column) -> Column:
    """Null for the empty string, as both count as missing."""
    return F.nullif(value, F.lit(""))


def optional_text(value: Column) -> Column:
    """The text as it is, null where it is empty."""
    return missing(value)
