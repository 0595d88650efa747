"""Training-data operators: filtering, deduplication, scoring, tokenising and packing."""
