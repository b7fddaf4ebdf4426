"""Operators for preparing training corpora, each built by its own named method.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it."""
