"""Layered (raw -> cleaned -> dimensional) batch analytics as plain Spark plans."""

__version__ = "0.1.0"
