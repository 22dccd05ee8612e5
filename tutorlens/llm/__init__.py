"""Operators for preparing language-model training corpora.

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and their SQL, ``corpus_pipeline.py`` at the repository top chains five
of the operators.
"""
