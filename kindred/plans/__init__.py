"""Queries over whole tables, with the SQL that checks them."""
