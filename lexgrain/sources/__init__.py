"""Readers, writers and parsers of XML, zip and JSONL files."""
