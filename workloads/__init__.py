"""The operators applied to the benchmark tables, with SQL to check them."""
