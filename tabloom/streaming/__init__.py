"""Fitted models applied to streams."""
