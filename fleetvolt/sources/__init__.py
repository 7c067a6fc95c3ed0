"""Readers and writers: typed input tables, the snapshot store, the sent-date log, exports."""
