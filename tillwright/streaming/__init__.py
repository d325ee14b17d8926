"""Click, session and change-feed jobs under Structured Streaming."""
