"""The operators as continuous queries."""
