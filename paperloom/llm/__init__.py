"""Training-data operators: fingerprints, filters, deduplication, search, sharding, token files and packing."""
