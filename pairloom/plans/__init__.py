"""Composite, user-level queries."""
