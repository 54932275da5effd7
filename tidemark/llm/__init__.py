"""Operators for preparing text corpora at scale: duplicates, filters, mixing, packing and archives.

Nothing else in the library imports this subpackage.
"""
