"""Reusable ``DataFrame -> DataFrame`` operators with keys and columns as arguments."""
