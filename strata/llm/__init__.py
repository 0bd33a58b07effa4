"""Training-data operators: scoring, filtering, deduplication and mixing of text corpora.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
