"""Readers and writers for filings, results and labels."""
