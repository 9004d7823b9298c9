"""Scoring of arriving responses (Structured Streaming, stateless)."""
