"""Operator chains: raw filings to graph tables, scores, labels and models."""
