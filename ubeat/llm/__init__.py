"""Operators of a training-data pipeline (decontamination, deduplication,
filtering, mixing, sharding, formatting); nothing else in ubeat imports it."""
