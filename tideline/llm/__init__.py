"""Operators for preparing training text: scoring, licences, duplicates, packing and filters."""
