"""Whole protocols built from the operators."""
