"""Registered queries and what they need around them."""
