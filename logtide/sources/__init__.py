"""Table scans, message-topic adapters and the area-mapping dimension provider."""
