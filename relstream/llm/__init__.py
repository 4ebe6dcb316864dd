"""Operators for preparing training text: extraction, scoring, deduplication, decontamination, packing, sharding.

Nothing else in the package imports this folder. Queries over the shared tables are in `queries`.
"""
