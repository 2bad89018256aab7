"""pactline."""
