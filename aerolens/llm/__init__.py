"""Operators for preparing language-model training text.

One module per operator; nothing else in the library imports this package.
"""
