"""Registered queries over the supplied tables, with the SQL that each must equal."""
