"""Bindings of concrete table sets to the roles the reports read."""
