"""Registered queries over the supplied tables, each with the SQL that states the same result where SQL can."""
