"""Extraction over filings as they arrive."""
