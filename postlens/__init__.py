"""Labelled-text stream analytics as DataFrame -> DataFrame operators."""

__version__ = "0.1.0"
