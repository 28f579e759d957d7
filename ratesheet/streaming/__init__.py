"""Structured Streaming jobs. Each takes its folders and a checkpoint folder, handles what
is there, and stops; run again, it handles only what is new."""
