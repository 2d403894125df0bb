"""Readers, the warehouse layout and its load log."""
