"""Training-data operators: sharding, token stores, near-duplicates, filters, packing.

Every operator takes a DataFrame and column names and returns a DataFrame; nothing
outside this subpackage imports it.
"""
