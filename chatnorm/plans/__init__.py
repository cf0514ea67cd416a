"""Whole jobs: the normalisation run, table de-duplication, run tracking."""
