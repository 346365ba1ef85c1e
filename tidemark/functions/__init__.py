from tidemark.functions.columns import commit_time_ms, floor_ms, ntz, row_bytes, sequence_hex

__all__ = ["commit_time_ms", "floor_ms", "ntz", "row_bytes", "sequence_hex"]
