"""Incremental landing of newly captured payload files."""
