"""Structured Streaming variants of batch operators.

The reproduced pipeline is batch-only; the one operator that naturally runs
incrementally — daily prices rolled up into monthly features as new daily
files land — is offered as a streaming query with a watermark so that state
stays bounded and each month is emitted once it can no longer change.
"""

from ledgerlake.streaming.monthly import monthly_price_stream

__all__ = ["monthly_price_stream"]
