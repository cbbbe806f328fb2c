"""Conversation-journey and booking-loss analytics as Spark DataFrame transforms."""
