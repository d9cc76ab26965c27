"""corpusq: analytics for digitized document corpora, written for Spark."""
