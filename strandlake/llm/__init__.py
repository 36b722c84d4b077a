"""Training-data operators: one module for each, DataFrame in and DataFrame out.

Nothing outside this package imports it, so the rest of the library works
without it.
"""
