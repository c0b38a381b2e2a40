"""Operators of a pipeline that prepares training text, each on its own and all optional."""
