"""The same loads and counts as data arrives (Structured Streaming)."""
