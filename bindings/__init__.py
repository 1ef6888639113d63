"""The operators bound to the supplied test tables, with an SQL statement to check each."""
