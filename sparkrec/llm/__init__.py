"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which belongs to
it) imports it. Every operator takes and returns DataFrames; its queries are
registered in ``sparkrec/llm/queries.py``.
"""
