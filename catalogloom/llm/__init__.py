"""Training-data operators: deduplication, classification, screening, tokens, packing and sharding."""
