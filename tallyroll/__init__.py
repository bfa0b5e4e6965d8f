"""Statement ingestion on Spark: vendor sales CSVs in, payments and songs out."""
