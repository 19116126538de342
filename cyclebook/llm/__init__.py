"""Operators for cleaning, deduplicating and encoding text corpora. Nothing outside imports them."""
