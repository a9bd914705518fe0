"""tillstream: a streaming retail warehouse written as Spark DataFrame jobs."""
