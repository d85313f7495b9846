"""Readers for landed files, record files, delimited fixtures, dated views and layouts."""
