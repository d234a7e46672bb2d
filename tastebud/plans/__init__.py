"""Runs: compositions of operators returning a dict of named products."""
