"""Column builders: expressions over cells, labels, sentences and vectors."""
