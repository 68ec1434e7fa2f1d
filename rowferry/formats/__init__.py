"""Payload text or bytes to rows, and rows to payloads."""
