"""Readers. Each returns a lazy DataFrame whose files Spark splits and reads in parallel."""
