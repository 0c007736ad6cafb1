"""daedap: open-domain question answering over text tables, as Spark jobs."""
