from sonde.sources.scans import (  # noqa: F401
    literal_table, load_instances, read_partitions, scan_csv, scan_parquet)
from sonde.sources.sinks import (  # noqa: F401
    append_metrics, write_csv, write_parquet, write_partitioned)
