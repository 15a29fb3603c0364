"""Where messages, events and stored views come from, and where messages go."""
