"""Training-data operators: packing, fingerprints, tokenizers, archives, deduplication, language ID, counts."""
