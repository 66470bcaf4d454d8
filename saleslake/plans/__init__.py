"""Whole jobs: the load from feed to gold, and the questions asked of gold."""
