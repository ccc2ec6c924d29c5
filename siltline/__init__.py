"""siltline: a Spark-native engine for curating large text and media-metadata corpora.

Everything is DataFrame in, DataFrame out.  Sub-packages: ``operators`` (relational and
deduplication operators), ``functions`` (scalar Column builders), ``sources`` (readers and writers),
``plans`` (pipelines, registry, demonstration queries), ``streaming`` and, kept apart from the
rest, ``llm`` (operators for training data)."""

__version__ = "0.1.0"
