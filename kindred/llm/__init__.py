"""Operators of a training-data pipeline: tokens, quality, duplicates, leaks, licences, chats."""
