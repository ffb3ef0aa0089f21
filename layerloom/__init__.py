"""Layered warehouse loads (landing, raw, staging, history) as Spark DataFrame functions."""
