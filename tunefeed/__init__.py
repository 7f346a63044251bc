"""tunefeed: the data side of supervised fine-tuning as Spark DataFrame jobs."""
