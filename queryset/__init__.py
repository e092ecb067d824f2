"""Registered queries: each Spark job next to the SQL that checks it."""
