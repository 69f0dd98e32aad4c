"""Operators for preparing training text: one module per operator, plus helpers.

Nothing outside this folder, ``corpus_pipeline.py`` and the guard in
``__spark_entry__.py`` imports it.
"""
