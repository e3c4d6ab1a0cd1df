"""Training-data operators: scoring, near-duplicate search, redaction, packing, sharding."""
