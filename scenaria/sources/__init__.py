"""Sources and sinks: scenario CSV folders, Parquet snapshots, report CSVs, model store."""
