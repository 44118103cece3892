"""Operators for preparing training data: text, tokens, embeddings, mixing."""
