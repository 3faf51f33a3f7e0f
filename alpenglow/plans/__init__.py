"""Analytical models over the weather table, and the end-to-end load."""
