"""Training-data operators over documents, pages and benchmark tables, and their queries."""
