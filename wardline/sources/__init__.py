"""Readers: metadata relations, saved tables, landed JSON payloads, fixed rows."""
