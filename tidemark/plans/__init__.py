"""Registered queries: each binds an operator to the given tables, with its SQL counterpart."""
