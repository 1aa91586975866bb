"""Arrival of claims as files, handled by the batch scoring flow."""
