"""Training-data operators over documents, pages and benchmark items.

Nothing outside this subpackage imports it.  Each operator module has a general
DataFrame interface; ``queries`` holds the thin contract queries and their SQL.
"""
