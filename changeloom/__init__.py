"""Spark operators that unify change feeds of several source databases into one multi-tenant table."""
