"""Readers: topics, tables, API payloads and web pages."""
