"""DataFrame -> DataFrame operators (no UDFs, no driver-side row loops)."""
