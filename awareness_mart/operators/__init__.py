"""Operators the loads and reports are composed of."""
