"""Operators for training-data pipelines: search, packing, archives, scans, mixing, deduplication.

Nothing else in the library imports this subpackage."""
