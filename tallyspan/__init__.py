"""Small-area statistics engine expressed as Spark DataFrame plans."""
