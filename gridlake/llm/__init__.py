"""Operators for training-data pipelines, one module per operator.

Each module holds the general operator (texts, spans, files in and out); the
thin ``opN_*`` queries and their SQL are in ``queries.py``. Nothing outside this
package imports it, apart from the guarded hook in ``__spark_entry__.py`` and
``corpus_pipeline.py``.
"""
