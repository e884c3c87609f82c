"""Readers. Each one reads a table or, with ``streaming=True``, a stream of the same shape."""
