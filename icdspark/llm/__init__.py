"""Operators for preparing language-model training text.

Each module holds one operator; ``queries`` registers them.  Nothing outside
this subpackage imports it.
"""
