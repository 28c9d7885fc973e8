"""Trading-trace dataset engine on PySpark."""
