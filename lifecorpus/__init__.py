"""lifecorpus: turn personal data exports into normalized message/document
tables and chat-format training examples, expressed as Spark jobs."""

from lifecorpus.settings import Settings

__all__ = ["Settings"]
