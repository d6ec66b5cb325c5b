"""Sources and sinks: landing feeds (JSONL), test-table envelopes, writers."""
