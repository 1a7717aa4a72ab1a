"""Part of the lemmata engine."""
