"""Relational operators that adapt to measured sizes and hot keys."""
