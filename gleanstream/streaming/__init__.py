"""The micro-batch consumer."""
