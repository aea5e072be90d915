"""Readers and writers for the file kinds that record and genome tools exchange."""
