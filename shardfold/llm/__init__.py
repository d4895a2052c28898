"""Training-data operators: text deduplication, tokenisation, filtering and formatting at corpus scale."""
