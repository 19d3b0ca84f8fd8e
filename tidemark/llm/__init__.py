"""Operators of a training-data pipeline over documents, pages, conversations and embeddings.

Each module is one operator with its own general interface; ``queries`` registers a query per operator.
"""
