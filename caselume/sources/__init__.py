"""Readers and writers for the file formats and the message queue."""
