"""Where records come from: topics, files, databases, and the supplied test tables."""
