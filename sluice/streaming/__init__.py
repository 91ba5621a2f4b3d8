"""The same columns on Structured Streaming sources."""
