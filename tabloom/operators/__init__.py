"""Operators over labelled tables: profile, decide, prepare, select, fit, evaluate, rank."""
