"""Whole chains of operators."""
