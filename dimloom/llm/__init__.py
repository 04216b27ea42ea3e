"""Operators for preparing language-model training text, one module per operator.

Nothing outside this subpackage imports it.  ``queries.py`` holds the registered queries.
"""
