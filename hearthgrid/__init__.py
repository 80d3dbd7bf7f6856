"""Household and cooperative utility analytics as Spark DataFrame functions."""
