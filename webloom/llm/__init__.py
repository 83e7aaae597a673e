"""Operators for building training corpora (the ten operators op1..op10 and their queries).

Nothing else in the library imports this package; it may import the library's general helpers.
"""
