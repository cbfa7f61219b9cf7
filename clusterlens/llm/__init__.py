"""Operators of a training-data pipeline over web-scale text.

Ten operators, one module each, plus ``queries`` (the registered
``opN_<name>`` queries). Nothing else in the library imports this package.
"""
