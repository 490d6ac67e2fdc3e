"""Operators of a training-data pipeline: mixing, near-duplicate removal, URL
filters, language-model scoring, quality rules, sharding, licence scans,
subword encoding and language identification.

Nothing else in the library imports this subpackage; it may be deleted.
"""
