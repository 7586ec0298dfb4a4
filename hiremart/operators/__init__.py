"""DataFrame → DataFrame operators of every layer (ODS, DDS, DQ, marts, BI, stats)."""
