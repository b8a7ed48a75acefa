"""Reading, validating, splitting and storing."""
