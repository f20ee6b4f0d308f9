"""The registered queries: matrices derived from the given tables, Spark plans and their SQL counterparts."""
