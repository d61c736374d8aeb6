"""Operators for training data: formatting, de-duplication, search, tokenizing and mixing."""
