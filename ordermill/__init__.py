"""Order analytics on Spark: cleaning, daily exchange rates and EUR marts."""
