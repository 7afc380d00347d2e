"""plotmill: a Spark-native engine that turns books, scripts and prompt records into instruction-tuning data.

Core modules never import :mod:`plotmill.llm`; that subpackage may be removed without affecting the rest.
"""

__version__ = "0.1.0"
