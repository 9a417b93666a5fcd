"""Operators that prepare language-model training text; nothing else in the library imports them."""
