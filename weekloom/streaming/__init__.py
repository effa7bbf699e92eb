"""Structured Streaming forms of the batch operators; equal to them once the input is complete."""
