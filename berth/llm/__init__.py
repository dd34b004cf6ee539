"""Operators of a training-data pipeline over documents, conversations and
embeddings. Nothing else in the library imports this package."""
