"""Staging, marts, reviews, checks and reports as DataFrame plans."""
