"""Runs over ranges of days: what is to be done, in which order, and the stages themselves."""
