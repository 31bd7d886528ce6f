"""Training-data operators: tokenizing, filtering, deduplication, packing, scoring, extraction.

Nothing outside this folder imports it; ``queries.py`` lists its registered queries.
"""
