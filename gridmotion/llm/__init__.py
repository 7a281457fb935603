"""Operators that prepare language-model training data; nothing else in the library imports them."""
