"""Sources (JSON Lines, file trees) and sinks (JSON Lines, nested project records)."""
