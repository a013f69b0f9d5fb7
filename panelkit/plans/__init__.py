"""The operators composed into the panel's end-to-end runs."""
