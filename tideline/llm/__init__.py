"""Training-data operators: each module is one operator over the corpus tables.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
