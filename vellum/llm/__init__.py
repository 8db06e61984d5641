"""Operators for preparing training text: ten components, each in a module of its own.

Nothing outside this subpackage imports it. ``queries`` holds the thin ``opN_*`` queries, the other modules
the operators with their general interfaces.
"""
