"""XML and HTML to Markdown, in plain Python: no Spark here. docflow.udfs applies it to columns."""
