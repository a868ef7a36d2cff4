"""Training-data operators: packing, deduplication, classifiers, scans, filters, mixing and search.

Nothing outside this subpackage imports it.
"""
