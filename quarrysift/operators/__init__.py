"""Search, statistics, chunking, embedding, matching, diffs and ranking."""
