"""Operators for large training corpora; see the README for the list.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their SQL twins.
"""
