"""Readers and writers for the lakehouse tables, feeds and topics."""
