"""The per-key activity rollups (check-ins, tips) over a growing folder of JSON-lines files."""

from sheaf.streaming.rollups import latest_rollup, run_rollup_stream, start_rollup_stream

__all__ = ["latest_rollup", "run_rollup_stream", "start_rollup_stream"]
