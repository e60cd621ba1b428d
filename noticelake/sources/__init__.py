"""Reading raw payloads, writing tables and keeping track of what was processed."""
