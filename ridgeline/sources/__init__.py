"""What is read and written: image corpora, feature tables, predictions, reports."""
