"""Operators for preparing language-model training corpora, one module each.

Nothing else in the library imports this subpackage.
"""
