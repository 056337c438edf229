"""Operators for building training corpora from documents; nothing else in the package imports them."""
