"""Operators for large training-data pipelines, and the queries that apply them.

Nothing outside this package imports it. Executors need the package on their path, as with
any module of Python functions: install it there, or ship it with ``--py-files``.
"""
