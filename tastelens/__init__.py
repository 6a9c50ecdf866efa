"""Review-corpus analytics on Spark: cleaning, audits, lexicon features, model evaluation."""

__version__ = "0.1.0"
