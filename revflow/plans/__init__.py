"""Composite plans: the marts, their publication, the load flow."""
