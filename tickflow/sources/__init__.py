"""Where messages, payloads and published results are read from."""
