"""Reading, checking and writing the four datasets."""
