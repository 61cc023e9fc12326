"""shelfmark: layered retail analytics expressed as Spark DataFrame operators."""
