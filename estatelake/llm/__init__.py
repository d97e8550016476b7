"""Training-data operators: line and document dedup, language id, packing,
secret scans, quality rules, exact search, WARC, mixing.

Nothing else in the library imports this subpackage.
"""
