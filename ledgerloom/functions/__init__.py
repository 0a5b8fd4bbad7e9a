"""Reusable ``Column`` builders.  Nothing here triggers a Spark job."""
