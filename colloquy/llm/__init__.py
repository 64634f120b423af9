"""Training-data operators: packing, filters, near-duplicates, language models, search, extraction, archives."""
