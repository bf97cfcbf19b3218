"""Sources and sinks: files, warehouse tables, loan events, Kafka and JDBC connectors."""
