"""Social-text analytics as Spark jobs: words, sentiment, organisations, vectors, streams."""
