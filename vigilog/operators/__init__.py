"""DataFrame -> DataFrame operators over parsed entries."""
