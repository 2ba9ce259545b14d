"""Operators that prepare text corpora for language-model training.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
