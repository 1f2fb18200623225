"""Reading, writing, naming and describing datasets."""
