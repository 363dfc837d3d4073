"""siftloom: curation of media metadata and text corpora as Spark jobs."""
