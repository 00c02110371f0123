"""parapet: parallel-corpus preparation, subword vocabularies, ensembles and BLEU on Spark."""

__version__ = "0.1.0"
