"""Streaming.

The reference job is batch-only: it has no stream source, watermark or
stateful operator.  The article preparation is stateless per record, so the
same operators apply unchanged to a streaming DataFrame; ``article_stream``
only wires the splittable XML record scan to ``readStream`` for users who
ingest new dump files as they land.  No streaming operator of its own is
added.
"""

from titlematch.streaming.articles import article_stream

__all__ = ["article_stream"]
