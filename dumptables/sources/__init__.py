from dumptables.sources.dump import RECORD_END, DumpOptions, scan_records, stream_records

__all__ = ["RECORD_END", "DumpOptions", "scan_records", "stream_records"]
