"""Training-data operators: sharding, mixing, dedup, tokens, language, secrets, nearest neighbours.

Nothing else in the package imports this one; ``registry`` lists its queries.
"""
