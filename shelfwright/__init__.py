"""Product-image catalogue curation as Spark DataFrame operators."""
