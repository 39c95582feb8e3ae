"""Whole jobs: they read, write and check."""
