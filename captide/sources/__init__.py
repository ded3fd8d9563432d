"""Readers: identifier lists, documents, commercial records, corpus files, archives."""
