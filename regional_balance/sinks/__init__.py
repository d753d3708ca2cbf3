"""Writers; the only place where the engine runs Spark actions on results."""
