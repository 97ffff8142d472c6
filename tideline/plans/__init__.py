"""Loads, reconciliation, outbox, quota and report frames built from the operators."""
