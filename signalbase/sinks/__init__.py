"""Stored tables and report tabs."""
