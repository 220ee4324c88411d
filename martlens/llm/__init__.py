"""Training-data operators: joins on text similarity, fingerprints, sharding,
embeddings, quality scoring, tokenisation, repeats, packing and URL rules.

Nothing outside this package imports it.
"""
