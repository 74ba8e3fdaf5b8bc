"""Training-data operators: language ID, dedup, licence and secret scans, chat
formatting, byte-level BPE, packing and exact vector search.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
