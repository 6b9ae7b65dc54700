"""Operators of a training-data pipeline over documents, pages, conversations and embeddings.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it; ``queries.py`` holds what ``__spark_entry__.py`` registers.
"""
