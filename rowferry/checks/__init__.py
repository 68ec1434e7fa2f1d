"""Registered queries, their plain SQL, and the inputs derived from the test tables."""
