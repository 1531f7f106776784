"""The toolkit's queries on the TPC-H-like test tables."""
