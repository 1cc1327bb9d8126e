"""Whole jobs: what is read, in which order results are written, and what is reported."""
