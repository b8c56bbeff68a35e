"""Operators of a training-data pipeline over documents and embeddings.

Nothing else in the library imports this subpackage. ``queries.py`` binds the operators to the
driver's tables; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
