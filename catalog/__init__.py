"""Registered queries on the retail tables and the SQL that checks them."""
