"""Operators for preparing training text of language models."""
