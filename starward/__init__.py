"""Star-schema warehouse loads for clinics, written as Spark DataFrame jobs."""
