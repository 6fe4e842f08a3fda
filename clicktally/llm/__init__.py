"""Operators for preparing training data: tokens, packing, shards, rules, scans, search, dedup."""
