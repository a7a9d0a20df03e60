"""Training-data operators: quality, dedup, packing, mixing, fingerprints, privacy, language.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
