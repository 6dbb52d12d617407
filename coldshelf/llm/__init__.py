"""Operators for training data: quality, packing, licences, scoring, duplicates, chat, tokens, toxicity."""
