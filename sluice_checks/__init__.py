"""The library's operators run over the given test tables, and the same results in SQL."""
