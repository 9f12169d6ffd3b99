"""Operators for large text corpora and their registered queries.

Nothing else in the library imports this subpackage.  ``registry`` lists the
queries; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
