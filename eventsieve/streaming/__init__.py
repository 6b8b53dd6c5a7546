"""Structured Streaming form of the stateless cleaning and rule steps."""

from eventsieve.streaming.validation_stream import start_validation_stream, validated_stream

__all__ = ["start_validation_stream", "validated_stream"]
