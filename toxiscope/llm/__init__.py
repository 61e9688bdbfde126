"""Operators for preparing language-model training data (documents, embeddings, conversations)."""
