"""The registered queries: the library over the given tables, each with its check SQL."""
