"""Table readers, dated CSV directories, tenant configuration and report sinks."""
