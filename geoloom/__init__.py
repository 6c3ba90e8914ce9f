"""Geo-temporal feature lakehouse on PySpark: plain DataFrame operators that Catalyst plans."""
