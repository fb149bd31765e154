"""Phrase sentiment on Spark: titles, lines, words, scores."""
