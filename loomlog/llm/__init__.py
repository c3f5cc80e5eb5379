"""Operators for training-data corpora: tokens, packing, quality, chat, personal data, near copies, URLs."""
