"""Training-data operators (text, vectors, conversations) and their queries.

Nothing else in the library imports this subpackage; it can be removed whole.
"""
