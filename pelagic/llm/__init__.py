"""Training-data operators: classifiers, mixing, similarity joins, packing, tokens, fingerprints, personal data."""
