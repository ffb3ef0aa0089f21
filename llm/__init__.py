"""Training-data operators: deduplication, quality, language, URLs, tokens and packing."""
