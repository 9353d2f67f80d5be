"""Registered queries: each runs one operator over the given tables and, where SQL can say the
same, carries the statement that must give the same rows."""
