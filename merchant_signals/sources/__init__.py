"""Sources and sinks: driver-table fixtures, raw/CSV/JSONL readers, exports."""
