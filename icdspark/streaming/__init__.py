"""Structured Streaming use of the stateless note operators.

The original work is batch only; what carries over to streams are the
row-level operators (note filter, cleaning, tokenising, code dotting).
"""

from icdspark.streaming.notes import stream_tokenized_notes, write_stream  # noqa: F401
