"""Earnings-per-share extraction from HTML filings, as Spark DataFrame operators."""

from pershare.plans.extract import eps_from_grid, extract_eps

__all__ = ["eps_from_grid", "extract_eps"]
