"""Whole questions and jobs, composed of operators."""
