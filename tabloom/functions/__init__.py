"""Column helpers and distributed numeric building blocks."""
