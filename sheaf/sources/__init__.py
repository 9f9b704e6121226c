"""Reading landed files as tables of raw documents, and writing results."""
