"""Structured Streaming: change-log stream apply with a bucketed, versioned target."""
