"""Named queries, the inputs they run on, and their SQL oracles."""
