"""Joins, trees, unions, shares and reports."""
