"""Landing a change log as a stream."""
