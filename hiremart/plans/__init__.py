"""Plans: the warehouse build (runs of ODS → DDS), the scheduled run, the query registry."""
