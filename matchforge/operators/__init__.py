"""Relational building blocks, each a composition of DataFrame operations."""
