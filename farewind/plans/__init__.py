"""The registered queries: each operator over the test tables, with its SQL counterpart."""
