"""Papers that keep arriving: the batch flows over a stream of files."""
