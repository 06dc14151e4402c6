"""Operators of a training-data pipeline: tokenizers, archives, quality, duplicates, language, toxicity, packing.

Nothing outside this folder imports it. Each module holds one operator with its own interface; ``queries``
registers one query per operator over the given tables.
"""
