"""Operators that prepare text corpora: tokens, cleaning, scoring, near copies, archives."""
