"""Composed jobs: the listing refresh and the set of market reports."""
