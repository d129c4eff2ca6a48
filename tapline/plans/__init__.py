"""Logical plans: type profiles and part layout."""
