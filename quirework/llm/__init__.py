"""Operators of a training-data pipeline; nothing else in quirework imports this subpackage."""
