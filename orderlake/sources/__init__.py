"""Reading and writing of files and tables."""
