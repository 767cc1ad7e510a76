"""Training-data operators: deduplication, decontamination, quality, language,
licence, extraction and mixing jobs over text and embedding tables. Nothing
else in the library imports this subpackage."""
