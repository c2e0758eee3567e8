"""Continuous refresh."""
