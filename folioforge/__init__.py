"""folioforge: page-layout records to validated catalog tables, on the Spark DataFrame API."""
