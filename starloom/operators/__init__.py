"""Relational building blocks: headers, validation, deduplication, keys, pairing, history."""
