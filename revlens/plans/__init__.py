"""Composite plans: whole jobs built from the operators."""
