"""Whole syncs, put together from the operators."""
