"""Reading and writing: documents, delimited files, event streams, warehouse tables."""
