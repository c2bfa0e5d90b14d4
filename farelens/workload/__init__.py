"""Registered queries over the supplied test tables, and the SQL that checks them."""
