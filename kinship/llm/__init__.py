"""Operators of a training-data pipeline over the tables ``documents``,
``labels``, ``embeddings`` and ``conversations``.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries, one per operator; ``corpus_pipeline.py`` at the top of the
repository chains five of the operators.
"""
