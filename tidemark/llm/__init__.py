"""Operators of a training-data pipeline: sharding, quality rules and classifier,
near-duplicate and substring dedup, decontamination, chat formatting, tokenizing,
language-model scoring and URL filters. Nothing outside this package imports it."""
