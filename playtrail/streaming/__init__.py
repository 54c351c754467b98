"""Streaming: none.

The reference reads every source as a whole-file batch; it has no watermark,
time window, state store or late-data handling (SURVEY section 2.10), so no
Structured Streaming operator is built. The batch operators take explicit
orders and keys, so an incremental variant could be added on ``readStream``
sources without changing their semantics.
"""
