"""Locusloom: Spark DataFrame operators for genome features, intervals, evidence tables and gene models."""
