"""Operators of a training-data pipeline: licences, quality, extraction, search,
similarity joins, deduplication, packing, mixing, classification, privacy.

Nothing else in the package imports this subpackage.  The operators are in
modules of their own; ``queries`` registers them over whole tables.
"""
