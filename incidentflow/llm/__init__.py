"""Training-data operators: one module for each, and their registered
queries in ``queries``.  Nothing outside this subpackage imports it but the
driver's entry file (guarded) and ``corpus_pipeline``."""
