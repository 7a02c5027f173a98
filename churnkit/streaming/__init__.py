"""Structured Streaming form of the per-user activity job."""
