"""Inputs: typed CSV ingestion (``csv``), Parquet layers (``tables``), and the mapping of the
driver's test tables onto the raw order tables (``adapter``)."""
