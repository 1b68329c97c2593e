"""Training-data operators: near-duplicates, suffix dedup, tokens, PII, secrets, packing, archives, quality, sharding, nearest neighbours, features, manifests.

Nothing else in the library imports this subpackage; deleting the folder leaves the rest working.
"""
