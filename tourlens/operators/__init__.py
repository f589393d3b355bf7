"""Reusable operators: keyed de-duplication, pair counting, matching, checks."""
