"""One query per operator over tables derived from the given ones, and its SQL twin."""
