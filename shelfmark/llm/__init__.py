"""Operators that prepare text corpora for training: counts, near copies, screens, repeats, tokens.

Nothing outside this package imports it; ``queries`` holds the named queries.
"""
