"""Training-data operators: mixing, joins on shingles, tokenizing, near-duplicates, archives,
quality rules, secrets, toxicity, repeated passages and sharding.

Nothing outside this subpackage imports it.
"""
