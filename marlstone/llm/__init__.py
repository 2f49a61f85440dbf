"""Training-data operators over text, vector and media tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with its own general interface; ``queries.py`` holds the thin registered
queries and ``sql.py`` their SQL.
"""
