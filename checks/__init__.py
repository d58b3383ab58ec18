"""Queries over the given tables that exercise every operator, each with equivalent SQL."""
