"""Sources and sinks: document shards, XML, text files, tables, archives."""
