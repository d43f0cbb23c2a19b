"""Operators that prepare texts for training language models.

Each module holds one operator with an interface of its own; ``queries.py`` applies the operators to the given
tables, ``oracles.py`` holds SQL for those that SQL can express. Nothing outside this package imports it.
"""
