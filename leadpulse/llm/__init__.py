"""Operators of a training-data pipeline: search, mixing, fingerprints,
near-duplicate removal, language, toxicity, secrets, packing, archives and
sharding. Nothing outside this subpackage imports it."""
