"""End-to-end jobs: build a corpus, build an index, search."""
