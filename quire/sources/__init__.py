from quire.sources.files import read_csv, read_parquet, read_table
from quire.sources.sinks import write_parquet, write_csv, save_model, load_model
from quire.sources.ingest import csv_to_parquet

__all__ = ["read_csv", "read_parquet", "read_table", "write_parquet", "write_csv", "save_model", "load_model", "csv_to_parquet"]
