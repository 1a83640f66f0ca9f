"""Operators for preparing text as training data; nothing else imports this."""
