from regiopanel.sources.csv_io import read_csv, read_csv_dir, schema_of, write_csv  # noqa: F401
from regiopanel.sources.export import run_export  # noqa: F401
from regiopanel.sources.tables import TableSet, read_jdbc  # noqa: F401
