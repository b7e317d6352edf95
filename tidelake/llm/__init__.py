"""Corpus operators for training-data pipelines.

Nothing else in the library imports this subpackage; it may be removed as a
whole.  Each module holds one operator with a general interface, the thin
query over the test tables, and (where SQL can express it) the oracle SQL.
"""
