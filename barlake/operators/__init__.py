"""Batch operators: DataFrame -> DataFrame functions over bars and trades."""
