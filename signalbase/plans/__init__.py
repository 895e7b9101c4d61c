"""Whole flows from landed rows to table rows."""
