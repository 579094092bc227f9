"""Whole jobs built from the operations."""
