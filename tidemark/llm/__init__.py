"""Operators for preparing language-model training data.

Every module here stands alone beside the analytics library: nothing outside
this folder imports it, and it can be deleted together with
``corpus_pipeline.py`` and ``tests/llm``.
"""
