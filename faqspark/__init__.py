"""faqspark: mine chat threads and styled documents into a searchable FAQ index with PySpark."""
