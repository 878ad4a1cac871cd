"""Readers, writers and the bindings of generic tables to the listing shapes."""
