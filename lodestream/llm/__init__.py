"""Training-data operators: tokenising, mixing, near-duplicates, scans and scores over document tables.

Nothing outside this subpackage imports it.
"""
