"""Operators of a training-data pipeline: near-duplicates, tokens, languages, quality, chats, licences, mixing, scoring.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
