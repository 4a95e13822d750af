"""Table sources, partition resolution and sinks."""
