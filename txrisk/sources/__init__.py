"""Reading and writing: topics, files, the lake, and keyed state tables."""
