"""Ready-made questions over history tables, hot views and message flow."""
