"""Operators: DataFrame -> DataFrame transforms shared by batch and streaming."""
