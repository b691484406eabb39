"""Training-data operators: sharding, filtering, deduplication and packing of document tables.

Nothing else in the library imports this package. :mod:`tellerline.llm.queries`
holds the registered queries; every other module is one operator or a helper
that several operators share.
"""
