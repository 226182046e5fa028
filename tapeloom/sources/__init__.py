"""Reading landed files, writing tables, run log and model storage."""
