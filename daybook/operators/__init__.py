"""Relational building blocks of the plans."""
