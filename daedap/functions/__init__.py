"""Column functions: text cleaning, tokens, token sequences."""
