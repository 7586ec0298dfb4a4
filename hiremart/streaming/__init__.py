"""Structured Streaming form of the scheduled load: each micro-batch of landed
pages is one committed warehouse cycle."""
