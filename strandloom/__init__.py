"""Concept-graph analytics on Spark DataFrames.

The core (``operators``, ``functions``, ``sources``, ``plans``, ``streaming``)
never imports the optional subpackage ``llm``.
"""

__version__ = "0.1.0"
