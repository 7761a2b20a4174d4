"""Typed projection and row formatting."""
