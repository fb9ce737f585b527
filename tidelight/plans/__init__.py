"""The operators applied to the given tables, each with the SQL it must agree with."""
