"""Monitors over the TPC-H-like tables, for the driver contract, the benchmark and the tests."""
