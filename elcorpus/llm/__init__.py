"""Training-data operators (fingerprints, filters, joins, packing, dedup).

Nothing else in the library imports this package; it may be removed as a
whole.
"""
