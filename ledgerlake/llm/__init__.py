"""Operators for training-data pipelines: packing, quality rules, near and
exact deduplication, decontamination, secrets, personal data, sharding and
chat formatting.  Nothing else in the library imports this subpackage."""
