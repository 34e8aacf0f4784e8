"""Operators over segments and characters."""
