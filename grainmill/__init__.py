"""grainmill: curation of multilingual text corpora as Spark DataFrame plans."""

__version__ = "0.1.0"
