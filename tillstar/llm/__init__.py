"""Operators for training-data pipelines: scoring, crawl records, packing, filtering, deduplication, mixing, search."""
