"""Operators of a training-data pipeline: scoring, extraction, token output,
archives, decontamination, quality rules, near-duplicates, sharding, tokenizing.

Each module holds one operator with its general interface and the thin query
(``opN_<name>``) that applies it to a whole table. Nothing else in the library
imports this package.
"""
