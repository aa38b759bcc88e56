"""Registered query plans over the lake's tables, and their SQL oracles."""
