"""ledgerlake: banking data laid out bronze, silver, gold, as Spark DataFrame operators."""
