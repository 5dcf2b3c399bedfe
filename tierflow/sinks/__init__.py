"""Table sinks: namespaces, batch landing with schema evolution, full refresh."""
