"""What is read and written: payload captures, dimensions, definition files, tables."""
