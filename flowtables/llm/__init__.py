"""Operators of a training-data pipeline: extraction, language, quality, duplicates, licences, mixing and packing.

Nothing else in the library imports this subpackage. Every operator module has its own general interface; the thin
queries over the standard tables and their SQL are in `queries`.
"""
