"""Loads, reports, audits: what the mart computes."""
