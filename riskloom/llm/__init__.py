"""Operators of a text-corpus pipeline; nothing else in the package imports this one."""
