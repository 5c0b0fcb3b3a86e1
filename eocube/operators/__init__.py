"""DataFrame operators over cell, point, observation and vertex tables."""
