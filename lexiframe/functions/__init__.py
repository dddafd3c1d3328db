"""Column functions."""

from .text import blank_or_spaced, literal_split, python_str, strip

__all__ = ["blank_or_spaced", "literal_split", "python_str", "strip"]
