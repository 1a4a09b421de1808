"""corvina: document-corpus analytics written as Spark plans."""
