"""Reading and writing registries, tracking tables, page files and artifacts."""
