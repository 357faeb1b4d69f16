"""Input datasets and their reader."""
