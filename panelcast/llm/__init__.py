"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing else in the library imports this package. Every operator takes the
frame, the names of its id and text columns and its parameters; other columns
of the frame are ignored, so their names cannot clash with results.
"""
