"""Training-data operators over text, conversations and benchmark tables.

Self-contained: nothing outside this subpackage imports it.
"""
