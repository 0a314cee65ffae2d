"""paperloom: intake, extraction, storage, search and reporting for scholarly papers, as Spark DataFrame operators."""
