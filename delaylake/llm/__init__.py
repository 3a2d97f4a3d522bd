"""Operators and registered queries for preparing training text.

Nothing outside this subpackage imports it; the entry point adds its queries when it is present.
"""
