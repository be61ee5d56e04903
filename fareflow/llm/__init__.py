"""Operators for large-scale training-data preparation.

One module per operator; ``queries.py`` registers one query for each and
``corpus_pipeline.py`` at the repository top chains five of them.  Nothing
else in the library imports this subpackage.
"""
