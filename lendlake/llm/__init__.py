"""Training-data operators: tokenising, filtering, deduplication, packing, output.

Nothing else in the library imports this subpackage.
"""
