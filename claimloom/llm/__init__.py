"""Training-data operators: search, deduplication, quality, mixing, sharding and packing."""
