"""Registered queries, their source mapping and their SQL oracles."""
