"""Training-data operators: decontamination, near duplicates, substring dedup, PII, quality rules, WARC
archive, token counts, packing, URL filters and language ID.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
