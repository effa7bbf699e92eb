"""Operators for text corpora: filters, deduplication, decontamination, scoring, mixing, formats.

Nothing else in the library imports this subpackage.
"""
