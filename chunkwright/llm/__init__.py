"""Training-data operators: fingerprints, license scans, deduplication, packing, mixing, search, PII and quality.

Nothing outside this subpackage imports it. ``registry`` holds its queries and their SQL.
"""
