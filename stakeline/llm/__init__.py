"""Operators for preparing training text: ten operators, their named queries and check statements."""
