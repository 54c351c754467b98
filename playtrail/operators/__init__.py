"""Operators of the inventory, grouped by kind."""
