"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage.  Each operator module has
its own general interface; ``queries.py`` derives the registered results.
"""
