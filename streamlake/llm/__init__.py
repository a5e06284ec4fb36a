"""Training-data operators (URL filter, dedup, mixing, packing, ...).

Nothing outside this subpackage imports it; ``jobs`` holds the queries.
"""
