"""Structured Streaming variants of the weather rollup and the enrichment."""
