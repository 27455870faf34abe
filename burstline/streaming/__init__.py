"""Running the transforms as Structured Streaming queries."""
