"""Sinks and result forms: numbered parts, manifest, encryption, JSON rows, many tables."""
