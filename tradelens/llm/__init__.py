"""Training-data operators: filters, deduplication, search, tokenisation and packing."""
