"""Streaming entry points.

The reference processes finished files only: no watermark, event-time window, state or late data.
What carries over is its source: scenario CSV folders.  ``scenario_stream`` reads that folder as a
file stream with the same header-derived schema and file-name key, so new scenario files can be
appended to a snapshot with ``foreachBatch`` (``append_to_snapshot``); the batch operators then run
on the snapshot as before.
"""

from scenaria.streaming.files import append_to_snapshot, scenario_stream

__all__ = ["scenario_stream", "append_to_snapshot"]
