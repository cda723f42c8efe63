"""Operators of a training-data pipeline (see README, "Training-data operators").

Nothing outside this subpackage imports it except ``__spark_entry__.py``
(guarded) and ``corpus_pipeline.py``.
"""
