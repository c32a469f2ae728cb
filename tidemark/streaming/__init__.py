"""Incremental runs.

The reference has no streaming operators (no watermark, window state or late data); its stages run
once per scrape and each writes a timestamped snapshot.  ``snapshots.incremental_silver`` is that
schedule expressed with Structured Streaming: new bronze runs are picked up as they land and each
micro-batch goes through the same batch operators.  No other streaming operator is offered.
"""
