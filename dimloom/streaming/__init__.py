"""Streaming.

The modelled pipeline is a full batch rebuild (the source project materialises every
table with a complete daily refresh and has no incremental, watermark or state
logic), so there is no streaming operator to provide.  The batch operators accept any
DataFrame, so they can also be applied inside ``foreachBatch`` of a Structured
Streaming query when the caller wants micro-batch refreshes.
"""
