"""A PySpark engine for regulatory-filing and document data."""

from ledgerlode.functions.identity import filing_id
from ledgerlode.functions.identity import inventory_document_id as document_id
from ledgerlode.operators.catalog import APPROVED_FORMS, LEDGER, Catalog, CatalogError, ConflictError, read_cached_catalog, scan_cached_filings, submission_rows
from ledgerlode.operators.samples import build, build_and_publish
from ledgerlode.operators.validation import SampleError, read_samples, validate_samples

__all__ = [
    "APPROVED_FORMS",
    "LEDGER",
    "Catalog",
    "CatalogError",
    "ConflictError",
    "SampleError",
    "build",
    "build_and_publish",
    "document_id",
    "filing_id",
    "read_cached_catalog",
    "read_samples",
    "scan_cached_filings",
    "submission_rows",
    "validate_samples",
]
