"""Test inputs derived from the driver's tables, and the SQL every query is checked against."""
