"""Whole reports and jobs built from the operators."""
