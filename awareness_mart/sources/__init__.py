"""Landed feeds, the HR extract, master data and the versioned table store."""
