"""The incremental load fed by a stream."""
