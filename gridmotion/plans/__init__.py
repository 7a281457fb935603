"""Composite tables built from the operators."""
