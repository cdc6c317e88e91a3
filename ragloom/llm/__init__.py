"""Operators for preparing training text: filters, formatting, sharding,
decontamination, near-duplicates, tokenising. Nothing outside this subpackage
imports it."""
