"""Table-to-table operators: joins, dedupe, chunking, vectors, search."""
