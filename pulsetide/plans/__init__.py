"""Whole jobs: batch layers, the command line, and the registered queries."""
