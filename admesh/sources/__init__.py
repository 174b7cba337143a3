"""Inputs: table scans and the purchase facts derived from them."""
