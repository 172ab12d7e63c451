"""Operators that prepare a text corpus for training. Nothing outside this
subpackage and ``corpus_pipeline.py`` imports it."""
