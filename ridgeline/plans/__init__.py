"""Whole jobs: compositions of the operators."""
