"""Registered queries and the device view they read."""
