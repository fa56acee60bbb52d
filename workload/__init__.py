"""The library's datasets bound to the benchmark tables, with the SQL to check them by."""
