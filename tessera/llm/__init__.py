"""Operators of a training-data pipeline over ``documents`` and ``pages``.

One module per operator; ``queries`` registers one query per operator and the
pipeline. Nothing else in the library imports this subpackage.
"""
