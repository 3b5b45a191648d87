"""Training-data operators: tokenizing, deduplication, filtering, packing, formatting and scoring."""
