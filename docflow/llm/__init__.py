"""Operators of a training-data pipeline; nothing else in docflow imports this subpackage."""
