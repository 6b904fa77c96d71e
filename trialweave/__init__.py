"""trialweave: augmentation, curation and trial analytics as PySpark DataFrame operators."""
