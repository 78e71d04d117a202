"""Composed jobs: the equity report and the jobs around it."""
