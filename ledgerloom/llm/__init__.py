"""Training-data operators: deduplication, packing, encoding, scoring and scanning of text corpora.

Nothing else in the library imports this subpackage.
"""
