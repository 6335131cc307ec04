"""DataFrame -> DataFrame operators shared by batch replays and streaming jobs."""
