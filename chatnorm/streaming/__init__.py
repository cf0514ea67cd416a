"""The run over a file stream."""
