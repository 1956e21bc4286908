"""Reusable DataFrame operators that know nothing about the shop model."""
