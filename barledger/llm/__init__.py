"""Operators for large training-text pipelines, with their queries and SQL.

Nothing else in the library imports this subpackage.  ``queries.py`` registers one query per
operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
