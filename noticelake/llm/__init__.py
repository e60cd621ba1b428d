"""Preparation of notices and texts as training data; nothing outside this folder imports it."""
