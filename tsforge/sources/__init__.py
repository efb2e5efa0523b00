"""Sources and sinks: CSV series, labelled directory trees, driver tables, writers."""
