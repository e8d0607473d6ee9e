"""Operators for preparing training text at scale, with their bound queries."""
