"""The engine bound to the test tables: registered queries and their SQL counterparts."""
