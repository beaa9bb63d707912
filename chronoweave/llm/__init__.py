"""Training-data operators: dedup, tokenisation, packing, classifiers, filters and search.

Nothing outside this subpackage imports it.
"""
