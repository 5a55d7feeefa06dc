"""Contact-centre and workforce analytics expressed as Spark DataFrame jobs."""
