"""Runs over a medallion layout, and the queries registered for the test tables."""
