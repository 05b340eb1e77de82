"""Training-data operators. Nothing else in the library imports this
subpackage; its queries are in ``spindle.llm.queries``."""
