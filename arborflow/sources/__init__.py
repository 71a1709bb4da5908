"""Readers and writers: source trees, event logs, state."""
