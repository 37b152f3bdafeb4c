"""Corpus operators for training data: scans, sharding, deduplication, decontamination, packing, archives.

Nothing outside this package imports it; ``queries`` registers one query per operator.
"""
