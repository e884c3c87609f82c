"""DataFrame -> DataFrame operators, for use with ``df.transform``.

They work on tables and on streams unless their docstring says otherwise.
"""
