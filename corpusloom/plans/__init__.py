"""Whole builds: curation (with release), evaluation sets, training sets."""
