"""Training-data operators: language, duplicates, leaks, personal data, tokens, search, packing and URL reputation."""
