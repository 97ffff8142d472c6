"""Relational building blocks, each a function of frames."""
