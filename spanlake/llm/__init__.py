"""Operators for preparing training text.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
interface; ``queries`` registers the thin ``opN_*`` queries over the supplied tables.
"""
