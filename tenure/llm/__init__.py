"""Operators for preparing text corpora: scans, dedup, fingerprints, mixing, tokens.

Nothing outside this package imports it. ``queries.py`` holds the thin
``opN_*`` queries, ``oracles.py`` their SQL where SQL can express them.
"""
