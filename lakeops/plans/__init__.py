"""The medallion dataflow and the catalogue of queries with their check SQL."""
