"""Operators for large text corpora that become training data.

Each module holds one operator with its own interface; :mod:`eocube.llm.queries`
applies them to the given tables. Nothing else in the library imports this package.
"""
