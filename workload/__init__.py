"""The engine's operators over the given tables, with the SQL that states their results."""
