"""Training-data operators: WARC normalising, quality rules, decontamination,
deduplication, packing, PII, language-model scoring.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
