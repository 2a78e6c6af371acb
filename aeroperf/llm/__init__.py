"""Training-data operators: deduplication, filtering, tokenising, packing, mixing, search."""
