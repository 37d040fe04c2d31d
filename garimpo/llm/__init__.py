"""Operators for training data: near copies, tokens, packing, filters, pages, search.

Nothing else in the package imports this folder.
"""
