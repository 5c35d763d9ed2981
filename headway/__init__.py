"""headway: public-transport crowding analytics as Spark DataFrame jobs."""
